import corpus_pipeline
import test_decontaminate
import test_minhash
import test_sites

from plumbline.llm import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    toxic, lines, near, leaks, pack = (f for _, f in corpus_pipeline.STAGES)

    score = toxicity.Scorer(toxicity.train(docs, labels))
    one = toxic(spark, docs, sf_dir)
    assert one.columns == COLUMNS
    assert sorted(rows_of(one)) == sorted(r for r in rows_of(docs) if 1 / (1 + 2.718281828459045 ** -score(r[1])) < 0.3)

    two = lines(spark, one, sf_dir)
    assert two.columns == COLUMNS and two.dtypes == docs.dtypes
    assert sorted(rows_of(two)) == sorted(r[:3] for r in test_sites.brute(rows_of(one), 10))
    assert two.where("n_chars <> length(text)").count() == 0

    three = near(spark, two, sf_dir)
    groups = test_minhash.brute(rows_of(two), 80)
    assert three.columns == COLUMNS
    assert sorted(rows_of(three)) == sorted(r for r in rows_of(two) if groups[r[0]][1] == r[0])

    four = leaks(spark, three, sf_dir)
    gone = {d for d, *_ in test_decontaminate.brute(rows_of(three), bench, 0.15, 8)}
    assert four.columns == COLUMNS
    assert sorted(rows_of(four)) == sorted(r for r in rows_of(three) if r[0] not in gone)

    packed = pack(spark, four, sf_dir)
    ran = corpus_pipeline.run(spark, sf_dir)
    assert {r[0] for r in packed.select("doc_id").collect()} == {r[0] for r in rows_of(four)}
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, ran.select(*own).collect())) == sorted(map(tuple, packed.select(*own).collect()))


def test_one_row_of_each_group_stays_whatever_its_id(spark, documents):
    text = "these words are said by two documents in quite the same way"
    lost = "nobody gave an id to any of the rows that say this one sentence"
    docs = documents([(2, text), (1, text), (1, text), (2, "but this one is only like itself and stays"), (None, text), (None, lost), (None, lost), (None, None), (None, "")])
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in out.collect()) == [(0, ""), (0, ""), (0, "nob"), (1, "the"), (2, "but")]
    assert out.columns == docs.columns


def test_columns_with_names_the_stages_use(spark, documents):
    text = "these words are said by two documents in quite the same way"
    docs = documents([(1, text), (2, text), (3, "another text that nobody else has written down so far")])
    for c in ("_row", "_doc", "_hash", "_at", "_group", "_rank", "_kept", "text_hash"):
        docs = docs.withColumn(c, docs["doc_id"])
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["_row"], r["_kept"]) for r in out.collect()) == [(1, 1, 1), (3, 3, 3)]
    gone = docs.select("doc_id", "text").withColumn("text_hash", corpus_pipeline.F.xxhash64("text")).where("doc_id = 1")
    assert sorted(r["doc_id"] for r in corpus_pipeline._without(docs, gone).collect()) == [2, 3]


def test_empty_documents_pass(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == COLUMNS and docs.count() == 0
