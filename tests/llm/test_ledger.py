"""A ledger that isn't there, and commits that fail or break off."""

from __future__ import annotations

import os

import pytest

from rollbook.llm.token_counts import commit_batch, totals

SCHEMA = "kind string, doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, old_tokens bigint"


@pytest.mark.usefixtures("few_rows")
def test_a_failed_commit_leaves_what_was_there(spark, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    insert = lambda *tokens: spark.createDataFrame([("insert", k, "a", "en", "v", n, None) for k, n in enumerate(tokens)], SCHEMA)
    got = lambda: [tuple(r)[3:] for r in totals(spark, ledger).collect()]
    assert got() == []
    commit_batch(insert(1, 2), ledger, "x")
    assert got() == [(2, 3)]
    with pytest.raises(Exception, match="unknown change"):
        commit_batch(insert(5).withColumnRenamed("kind", "k").selectExpr("'odd' AS kind", "* EXCEPT (k)"), ledger, "x")
    assert got() == [(2, 3)]
    commit_batch(insert(7), ledger, "x")
    assert got() == [(1, 7)]
    # a commit that broke off between its renames
    os.rename(tmp_path / "ledger" / "batch_id=x", tmp_path / "ledger" / "_former-x")
    assert got() == [(1, 7)]
    assert [n for n in os.listdir(tmp_path / "ledger") if n.startswith("_former")] == []
