"""The pipeline over a small table with planted cases, and its stages on odd rows."""

import pytest

import corpus_pipeline
from queuelens.llm.frames import kept
from queuelens.sources.schemas import TABLES

BENCHMARK = "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn"


def word(number):
    return "".join(chr(97 + number // 16 ** place % 16) for place in range(4))


def text(n, words=120):
    return " ".join(word((n * 7919 + i * i * 31) % 40_009) for i in range(words))


DOCS = [(n, text(n)) for n in range(60)]
TOXIC = [(100 + n, text(100 + n) + " you worthless rotten idiot " * 3) for n in range(40)]
COPIES = [(200, text(5)), (201, text(5) + " w1"), (202, text(5).upper())]
LEAKS = [(300, f"{text(300)} {BENCHMARK} {text(301)}")]
PRIVATE = [(400, text(400) + " mail a.b@c.de " + text(401))]
ODD = [(500, None), (None, text(77)), (3, text(3)), (501, text(501, 20_000)),
       (None, text(5)), (None, text(301) + BENCHMARK), (7, text(601)), (8, text(602) + " " + BENCHMARK)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(d, t, "en", "src", len(t or "")) for d, t in DOCS + TOXIC + COPIES + LEAKS + PRIVATE + ODD]
    spark.createDataFrame(rows, TABLES["documents"]).write.parquet(f"{path}/documents.parquet")
    labels = [(d, 1, int(d >= 100)) for d, _ in DOCS + TOXIC]
    spark.createDataFrame(labels, TABLES["labels"]).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, BENCHMARK)], TABLES["benchmark"]).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, []
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = kept(stage(spark, docs, folder), f"test-{place}")
        assert docs.columns == columns, name
        left.append([r.doc_id for r in docs.collect()])
    toxic, near, clean, private = (set(x) for x in left)
    assert not toxic & {d for d, _ in TOXIC} and {d for d, _ in DOCS} <= toxic
    assert not near & {200, 201, 202} and {d for d, _ in DOCS} <= near and None in near
    assert left[1].count(3) == 1  # a repeated row
    assert clean == near - {300} and private == clean
    # Rows without an id are copies or hold benchmark items like others; of one id, the other row stays.
    assert left[0].count(None) == left[1].count(None) + 1 == left[2].count(None) + 2
    assert (left[1].count(7), left[1].count(8), left[2].count(7), left[2].count(8)) == (2, 2, 2, 1)
    masked = docs.where("doc_id = 400").first()
    assert "[EMAIL]" in masked.text and "a.b@c.de" not in masked.text and masked.n_chars == len(masked.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == private


def test_run_and_empty_tables(spark, folder, tmp_path):
    whole = corpus_pipeline.run(spark, folder)
    assert whole.agg({"doc_id": "count"}).first()[0] > 60
    for name in ("documents", "labels", "benchmark"):
        frame = spark.createDataFrame([], TABLES[name])
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_masking_counts_every_document(spark):
    """A word in 150 of 30,000 texts is common and stays; one in 149 is the name of who is written to."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", """concat('row ', id, CASE
        WHEN id = 0 THEN ' write to painter@mail.example.org as painter said, to tulkin@mail.example.org as tulkin said'
        WHEN id <= 148 THEN ' painter tulkin' WHEN id = 149 THEN ' painter' ELSE '' END) AS text""")
    masked = corpus_pipeline.without_personal_data(spark, docs, "").where("doc_id = 0").first().text
    assert masked == "row 0 write to [EMAIL] as painter said, to [EMAIL] as [IDENTIFIER] said"
