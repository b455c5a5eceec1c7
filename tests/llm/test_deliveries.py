"""Exact dedup over several deliveries, with state that lives on."""

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import exact_dedup


def put(spark, path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(path))
    return spark.read.parquet(str(path))


def judged(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()}


def test_a_second_delivery_is_judged_against_the_first(spark, tmp_path):
    state = str(tmp_path / "state")
    one = put(spark, tmp_path / "one", [(1, "Alpha"), (2, "beta"), (3, "ALPHA"), (4, None)])
    two = put(spark, tmp_path / "two", [(0, "alpha"), (5, "Beta"), (6, "gamma"), (7, "")])
    assert judged(exact_dedup.deliver(one, state, "one")) == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}
    wanted = {0: (3, 3, False), 5: (5, 2, True), 6: (6, 1, True), 7: (7, 2, True)}
    assert judged(exact_dedup.deliver(two, state, "two")) == wanted
    assert judged(exact_dedup.deliver(two, state, "two")) == wanted  # given again: nothing is added
    both = exact_dedup.duplicates(one.unionByName(two))
    together = judged(both)
    assert {k: v[:2] for k, v in together.items() if k in wanted} == {k: v[:2] for k, v in wanted.items()}
    assert judged(exact_dedup.deliver(put(spark, tmp_path / "none", []), state, "three")) == {}
    assert judged(exact_dedup.deliver(one, state, "one"))[1] == (3, 3, False)


def test_unlike_texts_under_one_digest_stop_the_stream(spark, tmp_path):
    """A digest of two characters: against the delivery before, whichever of the two has the larger doc_id, and within one."""
    weak = lambda text: F.substring(text, 1, 2).cast("binary")
    state = str(tmp_path / "state")
    one = put(spark, tmp_path / "one", [(1, "abc"), (2, "xyz"), (3, "abc")])
    assert judged(exact_dedup.deliver(one, state, "one", weak))[1] == (3, 2, False)
    for k, rows in enumerate([[(4, "abd")], [(0, "abd")]]):
        with pytest.raises(Exception, match="DigestCollision"):
            exact_dedup.deliver(put(spark, tmp_path / f"two{k}", rows), state, f"two{k}", weak)
    with pytest.raises(Exception, match="DigestCollision"):
        exact_dedup.deliver(put(spark, tmp_path / "own", [(4, "abd"), (5, "abc")]), str(tmp_path / "other"), "own", weak)
