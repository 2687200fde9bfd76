"""Connected components of an edge table."""

from ledgerlake.operators.graph import connected_components


def test_components_of_paths_hubs_and_cycles(spark):
    edges = [(i, i + 1) for i in range(120)] + [(1000, i) for i in range(1001, 1400)] + [(2000, 2001), (2001, 2002), (2002, 2000),
             (5, 5), (None, 4), (3000, 3000), (2000, 2001)]
    df = spark.createDataFrame(edges, "a long, b long")
    got_ = {r.node: r.component for r in connected_components(df).collect()}
    want = {i: 0 for i in range(121)} | {i: 1000 for i in range(1000, 1400)} | {2000: 2000, 2001: 2000, 2002: 2000}
    assert got_ == want
