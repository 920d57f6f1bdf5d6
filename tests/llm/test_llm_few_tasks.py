"""Links of a few documents are closed and verified by a few tasks, however many partitions exchanges have."""

from pyspark.sql import functions as F

from headway.llm import jaccard_join as jj

HOT = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _recorded(monkeypatch):
    parts, real = [], jj.pinned

    def pinned(df):
        out = real(df)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(jj, "pinned", pinned)
    return parts


def test_few_links_are_closed_by_few_tasks(spark, monkeypatch):
    before = {k: spark.conf.get(k) for k in HOT}
    parts = _recorded(monkeypatch)
    try:
        for k, v in HOT.items():
            spark.conf.set(k, v)
        links = jj.pinned(spark.range(30).where("id % 10 < 9").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(40))
        parts.clear()
        got = {r.doc_id: r.component_id for r in jj.connected(links).collect()}
        assert got == {k: k // 10 * 10 for k in range(30)}
        assert parts and max(parts) <= jj.LEAST_TASKS
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_links_keep_their_tasks(spark, monkeypatch):
    monkeypatch.setattr(jj, "TASK_ROWS", 1)
    assert jj._in_few(spark.range(100).repartition(30), 100).rdd.getNumPartitions() == 30
    assert jj._in_few(spark.range(100).repartition(30), 20).rdd.getNumPartitions() == 20
