"""The SQL of the dialogues on hand-made tables: over a thousand turns, parts, null ids and numbers."""

from __future__ import annotations

from compare import differences, duck

from rollbook.llm import queries


def test_long_dialogues(spark, tmp_path):
    rows = [(1, k, ("ann", "bob", "system", None)[k % 4], f"t{k}") for k in range(1200)] + [(2, k, ("ann", "bob")[k % 2], "x" * 200_000) for k in range(9)]
    rows += [(None, None, "cy", None), (None, 5, "cy", "a"), (None, 5, "cy", "a"), (3, 1, "system", "alone"), (4, 1, " ", "who")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7).write.parquet(f"file://{tmp_path}/conversations")
    con = duck(str(tmp_path))
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations/*.parquet'")
    query = lambda s, folder: queries.op7_chat_format(s, folder)
    import rollbook.llm.queries as q

    stored, q.table = q.table, lambda s, folder, name: s.read.parquet(f"{folder}/{name}")
    try:
        assert differences(query(spark, f"file://{tmp_path}"), con, queries.SQL["op7_chat_format"]) == []
    finally:
        q.table = stored
