"""The pipeline's language stage decides what is packed together."""

from ledgerline.llm import langid, packing, tokens

D = "/root/testdata/sf0.001"


def test_sequences_hold_one_predicted_language(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, D).collect()
    pred = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark.read.parquet(f"{D}/documents.parquet")).collect()}
    of = {}
    for r in rows:
        assert r["lang_pred"] == pred[r["doc_id"]]
        of.setdefault(r["sequence_id"], set()).add(r["lang_pred"])
    assert all(len(x) == 1 for x in of.values())
    assert set.union(*of.values()) == set(pred.values())


def test_the_prediction_goes_by_the_text_whatever_lang_says(spark):
    frame = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang").limit(60).cache()
    docs = frame.unionByName(spark.createDataFrame([(10**6 + i, r["text"], None if i % 2 else "en") for i, r in enumerate(frame.collect())], frame.schema))
    pred = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    got = langid.recognised(docs, named="guess").collect()
    assert len(got) == 120 and all(r["guess"] == pred[r["doc_id"]] for r in got)
    assert {r["lang"] for r in got if r["doc_id"] >= 10**6 and r["doc_id"] % 2 == 0} == {"en"}
    again = langid.recognised(docs.withColumn("guess", docs["lang"]), named="guess")
    assert again.columns == ["doc_id", "text", "lang", "guess"] and sorted(map(str, again.collect())) == sorted(map(str, got))
    nothing = docs.withColumn("lang", docs["lang"].substr(1, 0)).where("false").unionByName(frame.selectExpr("doc_id", "text", "cast(NULL AS string) AS lang"))
    assert {r["guess"] for r in langid.recognised(nothing, named="guess").collect()} == {langid.UNKNOWN}


def test_groups_share_no_sequence_and_lose_no_id(spark):
    texts = {i: f"Words {i}. " * (i % 40) for i in range(200)}
    group = {i: (None, "a", "b", "c d", "")[i % 5] for i in texts}
    docs = spark.createDataFrame([(i, t, group[i]) for i, t in texts.items()], "doc_id int, text string, `the group` string").repartition(3)
    library = tokens.Encoder(tokens.public_path()).library
    for held in (10**9, 200, 0):
        rows = packing.pack(docs, length=64, block=300, by="the group", held=held).collect()
        of, ids = {}, {}
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["the group"] == group[r["doc_id"]] and r["start"] == len(ids.get(r["doc_id"], b"")) // 4
            ids[r["doc_id"]] = ids.get(r["doc_id"], b"") + r["ids"]
            of.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["the group"]))
        assert {i: len(x) // 4 for i, x in ids.items()} == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
        for own in of.values():
            at = 0
            for offset, length, _ in sorted(own, key=lambda x: x[:2]):
                assert offset == at
                at += length
            assert at <= 64 and len({x[2] for x in own}) == 1
    assert packing.packed(docs, by="the group").columns[-1] == "the group"


def test_bounds_on_a_worker_change_no_row(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(40).repartition(2, "doc_id").cache()
    plain = sorted(map(tuple, packing.packed(docs, by="lang").collect()), key=str)
    for piece, capacity in ((1, 0), (1 << 19, 1 << 17)):
        assert sorted(map(tuple, packing.packed(docs, by="lang", piece=piece, capacity=capacity).collect()), key=str) == plain
