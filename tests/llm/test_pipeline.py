"""The pipeline against the plain versions of its stages."""

import base64

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tests.llm.test_contamination import plain as plain_contamination
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_suffixes import plain as plain_repeats
from tests.llm.test_suffixes import runs

BASE = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def kept_text(text, gone):
    data, out, at = (text or "").encode(), "", 0
    for start, end in [*runs(gone), (None, None)]:
        out += data[at:start].decode(errors="ignore")
        at = end
    return out


def test_stages_against_plain_versions(spark):
    documents = spark.read.parquet(f"{BASE}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, " 12 - 3", "en", "x", 7), (9003, "", "de", None, 0)], documents.schema)
    docs = documents.unionAll(odd)
    stages = dict(corpus_pipeline.STAGES)

    def run(name, df):
        return spark.createDataFrame(stages[name](spark, df, BASE).collect(), documents.schema)

    known = run("language", docs)
    assert known.columns == COLUMNS
    have = {row.doc_id: row.text for row in known.collect()}
    assert set(have) <= {row.doc_id for row in documents.collect()} and len(have) > 190

    ids = sorted(have)
    first = plain_components([plain_fingerprint(have[id]) for id in ids], 4)
    single = run("near_copies", known)
    assert sorted(row.doc_id for row in single.collect()) == [ids[at] for at in sorted(set(first))]

    rows = {row.doc_id: row.text for row in single.collect()}
    ids = sorted(rows)
    want = {id: kept_text(rows[id], gone) for id, gone in zip(ids, plain_repeats([rows[id] for id in ids], 100))}
    cut = run("repeats", single)
    assert cut.columns == COLUMNS
    assert {row.doc_id: (row.text, row.n_chars) for row in cut.collect()} == {id: (text, len(text)) for id, text in want.items()}

    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{BASE}/benchmark.parquet").collect()]
    clean = run("decontamination", cut)
    left = {}
    for id, text in want.items():
        count, hit, _ = plain_contamination(text, items)
        if not (hit > 0 and 20 * hit >= count):
            left[id] = text
    assert {row.doc_id: row.text for row in clean.collect()} == left

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    tokens = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = stages["bpe"](spark, clean, BASE).collect()
    assert {row.doc_id: row.n_tokens for row in coded} == {id: len(tokens.encode_ordinary(text)) for id, text in left.items()}


def test_run(spark):
    rows = corpus_pipeline.run(spark, BASE)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 100 < rows.count() < 200


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, BASE)
        assert made.count() == 0
        if made.columns == COLUMNS:
            docs = made
