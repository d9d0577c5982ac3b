"""Trust over long paths, with the production rounds."""

from strokelab.llm import url_graph


def test_trust_reaches_far_hosts(spark):
    n = 24
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(n)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h0", 1.0)], "host string, w double")
    got = {r["host"]: r["rank"] for r in url_graph.personalised_pagerank(seeds, edges, 0.85, 1e-6).collect()}
    total = sum(0.85**i for i in range(n + 1))
    assert all(abs(got[f"h{i}"] - 0.85**i / total) < 1e-5 for i in range(n + 1))
