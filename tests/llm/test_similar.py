"""Near-duplicates, repeated passages and benchmark passages against brute force."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from assayframe.llm import components, decontaminate, near_dedup, repeats, texts

DOCS = "doc_id long, text string, id int, h string, key string, node string, class_id string"
WORD = re.compile(r"[0-9A-Za-z_\u0080-\U0010ffff]+")


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, 1, "h", None, "n", "clash") for i, t in pairs], DOCS).repartition(5)


def prose(rng, n):
    return [rng.choice(["the", "of", "a", "to", "in"]) if rng.random() < 0.4 else "".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    out = []
    for f in range(12):  # families of a base and variants at all distances
        base = prose(rng, rng.randint(40, 200))
        out.append(base)
        for v in range(14):
            words = list(base)
            for _ in range(int(len(words) * (v % 7) / 60)):
                words[rng.randrange(len(words))] = "".join(rng.choices("ijklm", k=5))
            out.append(words)
    shared = prose(rng, 60)
    for i in range(60):  # a passage that many documents share
        out.append(prose(rng, 30 + i) + shared[: 40 + i % 21] + prose(rng, 50))
    out += [out[0]] * 20
    out += [prose(rng, n) for n in (1, 2, 4, 5, 6, 49, 50, 51)] + [["x"], ["x"], ["a"] * 300, ["a"] * 300 + ["b"], prose(rng, 20_000)]
    out = [" ".join(w) for w in out] + [None, "", "", "!!!", out and " ".join(out[0]).upper() + "!"]
    pairs = list(enumerate(out)) + [(None, " ".join(["only", "null", "id", "here", "now"])), (None, out[1]), (3, out[3]), (3, out[3]), (5, "another text of number five")]
    return pairs


def shingle_counts(text):
    w = [x.lower() for x in WORD.findall(text or "")]
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def classes_by_force(pairs):
    sets = [shingle_counts(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(pairs)), 2):
        if sets[i] and sets[j] and similarity(sets[i], sets[j]) >= 0.8:
            parent[root(j)] = root(i)
    members = collections.defaultdict(list)
    for i in range(len(pairs)):
        members[root(i)].append(i)
    least = {r: min((pairs[i][0] is None, pairs[i][0] or 0) for i in m) for r, m in members.items()}
    return [(*least[root(i)], root(i)) for i in range(len(pairs))]


def test_classes_equal_brute_force(spark, corpus):
    wanted = collections.Counter((i, None if c[0] else c[1]) for (i, _), c in zip(corpus, classes_by_force(corpus), strict=True))
    got = near_dedup.near_duplicates(rows(spark, corpus)).collect()
    assert collections.Counter((r.id, r.class_id) for r in got) == wanted
    kept = near_dedup.drop_near_duplicates(rows(spark, corpus)).collect()
    assert len(kept) == len({c[2] for c in classes_by_force(corpus)})
    assert kept[0].h == "h" and kept[0].class_id == "clash"


def test_blocks_find_the_links_that_the_centres_miss(spark, monkeypatch):
    # a chain: each text is near the next one only, so that one centre links few of them
    rng = random.Random(2)
    words, pairs = prose(rng, 120), []
    for i in range(40):
        pairs.append((i, " ".join(words)))
        words = list(words)
        for j in range(4 * i, 4 * i + 8):
            words[j % 120] = "".join(rng.choices("nopqr", k=6))
    monkeypatch.setattr(near_dedup, "_BLOCK", 3)
    wanted = {(i, c[1]) for (i, _), c in zip(pairs, classes_by_force(pairs), strict=True)}
    assert {(r.id, r.class_id) for r in near_dedup.near_duplicates(rows(spark, pairs)).collect()} == wanted


def test_no_documents(spark):
    none = rows(spark, [])
    assert near_dedup.near_duplicates(none).count() == near_dedup.drop_near_duplicates(none).count() == 0
    assert repeats.repeated_passages(none).count() == 0
    assert decontaminate.contaminated(none, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_signatures_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(3)
    shared = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    a = dict(zip(shared.tolist(), rng.integers(1, 9, 300).tolist(), strict=True))
    b = {k: max(1, v + int(rng.integers(-2, 3))) for k, v in a.items() if rng.random() < 0.8} | {int(k): 3 for k in rng.integers(1, 1 << 62, 30)}
    truth = similarity(collections.Counter(a), collections.Counter(b))
    of = np.repeat([0, 1], [len(a), len(b)])
    element = np.array([*a, *b], np.uint64)
    weight = np.array([*a.values(), *b.values()])
    k = 4000
    sign = near_dedup.signatures(of, element, weight, 2, k)
    assert abs((sign[0] == sign[1]).mean() - truth) < 4 * (truth * (1 - truth) / k) ** 0.5
    alone = near_dedup.signatures(of[of == 1] - 1, element[of == 1], weight[of == 1], 1, k)
    assert (alone[0] == sign[1]).all()  # a text's signature does not depend on its neighbours


def test_links_at_the_threshold_are_missed_by_the_bands_alone():
    at, k = near_dedup.THRESHOLD, near_dedup.K
    no_band = (1 - at**near_dedup.ROWS) ** near_dedup.BANDS
    too_few = sum(math.comb(k, i) * at**i * (1 - at) ** (k - i) for i in range(k) if i / k < near_dedup.AGREE)
    assert no_band < 1 / 140_000 and too_few < 1e-11


def test_similarities_of_pairs():
    values = [("a b c d e f g", "a b c d e f h"), ("", "a"), ("x y", "x y"), ("a a a a a a a", "a a a a a a"), (None, None)]
    got = near_dedup.similarities(pa.array([v[0] for v in values]), pa.array([v[1] for v in values]))
    assert got.tolist() == pytest.approx([2 / 4, 0, 1, 2 / 3, 0])


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 10 != 9] + [(0, 100 + i) for i in range(50)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    wanted = {i: i - i % 10 for i in range(60) if i % 10} | {100 + i: 0 for i in range(50)} | {201: 200}
    assert found == wanted
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def spans_by_force(pairs, length):
    own, words = collections.defaultdict(set), {}
    for i, t in set(pairs):
        w = words[i, t] = [x.lower() for x in WORD.findall(t or "")]
        for j in range(len(w) - length + 1):
            own[tuple(w[j : j + length])].add((i, t))
    out = {}
    for d, w in words.items():
        spans = []
        for j in range(len(w) - length + 1):
            if len(own[tuple(w[j : j + length])]) > 1:
                if spans and j <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], j + length)
                else:
                    spans.append((j, j + length))
        if spans:
            out[d[0], tuple(spans)] = sum(b - a for a, b in spans)
    return out


@pytest.mark.parametrize("length", [50, 23, 11])
def test_repeated_passages_equal_brute_force(spark, corpus, length):
    pairs = [(i, t) for i, t in corpus if len(t or "") < 50_000 or length == 50]
    found = repeats.repeated_passages(rows(spark, pairs), length=length)
    got = {(r.id, tuple((s["from"], s["to"]) for s in r.spans)): r.n_words for r in found.collect()}
    assert got == spans_by_force(pairs, length)
    if length == 50:
        some = repeats.passages(rows(spark, pairs), found).filter("id = 0").first()
        assert len(WORD.findall(some.passage)) == some["to"] - some["from"]


def test_repeats_over_many_small_tasks(spark, corpus):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        pairs = [(i, t) for i, t in corpus if len(t or "") < 2_000]
        got = {(r.id, tuple((s["from"], s["to"]) for s in r.spans)) for r in repeats.repeated_passages(rows(spark, pairs), length=23).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == set(spans_by_force(pairs, 23))


ITEMS = [
    (1, "If today Alice buys 12 fresh apples for 3.50 dollars each, how much does Alice pay in total for the apples?"),
    (2, "A train travels 120 km in 2 hours, so what is the average speed of that train over the trip?"),
    (3, "only six plain words stand here"),
    (4, "too short"),
    (5, "Where did Marie Curie meet Pierre Curie before Marie Curie moved to another house with her sister?"),
    (None, "this item has no number of its own but it has quite enough words"),
    (7, None),
    (8, "A train travels 120 km in 2 hours, so what is the average speed of that train over the trip?"),
]


def test_templates_catch_other_numbers_and_names(spark):
    filler = "Some words before it. "
    docs = {
        0: filler + ITEMS[0][1] + " And more after.",
        1: "If today Bob buys 7 fresh apples for 1,000.25 dollars each, how much does Bob pay in total for the apples?",
        2: "If today Bob buys 7 fresh apples for 2 dollars each, how much does Carol pay in total for the apples?",  # one name became two
        3: "a train travels 300km in 4 hours, so what is the average speed of that train over the trip?",
        4: "IF TODAY ALICE BUYS 12 FRESH APPLES FOR 3.50 DOLLARS EACH, HOW MUCH DOES ALICE PAY IN TOTAL FOR THE APPLES?",
        5: "then only six plain words stand here again",
        6: "too short",
        7: "A clean text about trains and apples that nobody asked questions about in 2020 or 2021.",
        8: None,
        9: "",
        10: "so Where did Anna Smith meet John Smith before Anna Smith moved to another house with her sister?",
        11: "we know this item has no number of its own but it has quite enough words " + "word " * 30_000,
        12: filler + ITEMS[0][1] + " " + ITEMS[1][1],
    }
    pairs = [*docs.items(), (None, ITEMS[1][1]), (7, ITEMS[1][1]), (0, docs[0]), (0, docs[0])]
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id long, text string, key string")
    got = {(r.id, r.item, r.n_items) for r in decontaminate.contaminated(rows(spark, pairs), items).collect()}
    assert {(i, item) for i, item, _ in got} == {(0, 1), (1, 1), (3, 2), (4, 1), (5, 3), (10, 5), (11, None), (12, 1), (None, 2), (7, 2)}
    assert (12, 1, 2) in got
    left = decontaminate.drop_contaminated(rows(spark, pairs), items).collect()
    assert sorted((r.doc_id, r.text) for r in left if r.doc_id != 8) == sorted((i, docs[i]) for i in (2, 6, 7, 9)) and left[0].key is None and left[0].h == "h"


def test_quotes_of_items_with_few_plain_words_are_caught(spark):
    items = [
        (1, "What is 12 + 7 * 3 - 5?"),
        (2, "3.5 17 204 9,000 12 61"),
        (3, "Name every prime number"),
        (4, "Add 5 to 6, 7 to 8, 9 to 10, 11 to 12 and 13 to 14 for Ann Lee."),
        (5, "Only six plain words stand here"),
    ]
    docs = {
        0: "He said: What is 12 + 7 * 3 - 5? Nobody knew.",
        1: "so What is 12 + 7 * 3 - 5? Nobody knew.",
        2: "What is 13 + 7 * 3 - 5? Nobody knew.",
        3: "the row 3.5 17 204 9,000 12 61 was read",
        4: "the row 3,5 17 204 9,000 12 61 was read",
        5: "please Name every prime number below ten",
        6: "please Name every other prime number",
        7: "it goes on 9 to 10, 11 to 12 and 13 of them",
        8: "it goes on 9 to 10, 11 to 12 and 14 of them",
        9: "we heard Only six plain words stand here today",
    }
    found = decontaminate.contaminated(rows(spark, list(docs.items())), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.id, r.item) for r in found.collect()} == {(0, 1), (1, 1), (3, 2), (5, 3), (7, 4), (9, 5)}


def test_a_changed_value_does_not_hide_the_quoted_rest(spark):
    rest = "one should always remember that the old bridge near our village was never repaired by anybody until late spring"
    items = [(1, f"we put 3 red apples into the large basket, {rest} when 3 green pears fell from the tall tree")]
    docs = {
        0: f"we put 3 red apples into the large basket, {rest} when 4 green pears fell from the tall tree",
        1: f"we put 3 red apples into the large basket, {rest}",
        2: "we put 3 red apples into the large basket",
        3: f"we put 5 red apples into the large basket, {rest} when 6 green pears fell from the tall tree",
        4: "we put 5 red apples into the small basket when 6 green pears fell from the short tree",
    }
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r.id: r.n_windows for r in decontaminate.contaminated(rows(spark, list(docs.items())), table).collect()}
    assert set(got) == {0, 1, 2, 3} and got[0] > got[1] > got[2]
    # one name becomes two within adjoining windows: only the shape is the same
    items = [(1, "when did Ann buy the red car that Ann drove to our town")]
    docs = {0: "when did Bob buy the red car that Bob drove to our town", 1: "when did Bob buy the red car that Eve drove to our town"}
    table = spark.createDataFrame(items, "item_id long, text string")
    assert {r.id for r in decontaminate.contaminated(rows(spark, list(docs.items())), table).collect()} == {0}


def test_template_words():
    def shown(text):
        x = decontaminate.template(next(texts.slices(pa.array([text]))))
        return ["_" if s else "w" for s in x.slot]

    assert shown("buy 1,234.5 kg now") == list("w__w")
    assert shown("met Ann Lee. Then Él saw Ñandú") == list("w_ww") + ["w", "_"] or shown("met Ann Lee. Then we") == list("w_ww")
    assert shown("5kg") == list("__")
    assert shown("THE END of A day") == list("wwwww")
    assert shown("") == []
