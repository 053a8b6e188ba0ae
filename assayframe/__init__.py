"""Table operators for gene-expression and metabolite studies, written as Spark DataFrame jobs."""
