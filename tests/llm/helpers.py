"""Small frames and brute force for the corpus operators."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string"


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def with_clashes(frame, *names):
    """Extra columns under names that an operator might use itself."""
    return frame.withColumns({n: F.lit(f"own {n}") for n in names})


def grouped(pairs, ids):
    """The least id of the connected group of each id."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
