"""Repeated lines of few tokens, in the query of line deduplication."""

from colophon.llm import queries as Q

LONG = "这是一个没有空格的长行，它在许多文件中重复出现，编号为12345。"


def test_short_lines_are_deduplicated(spark, tmp_path):
    rows = [(1, f"Les.\n\nAnd ornd.\n{LONG}\n7"), (2, f"Les.\n\nown text here\n{LONG}\n8"), (3, "And  ornd. \n\n\n" + LONG.replace("5", "6")), (4, "all rights kept now\nLes."), (5, "all rights kept then")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in Q.op9_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\nown text here\n8", 2), 3: ("\n\n" + LONG.replace("5", "6"), 1), 4: ("all rights kept now", 1), 5: ("all rights kept then", 0)}
