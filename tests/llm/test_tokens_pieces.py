import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from basketry.llm import pieces, queries, token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sp(model):
    return sentencepiece.SentencePieceProcessor(model_file=model)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1_equals_the_library(spark, docs, sp):
    got = {r.doc_id: r for r in queries.op1_token_counts(spark, SF).collect()}
    want = docs.collect()
    assert len(got) == len(want)
    for r in want:
        n = len(sp.encode(r.text))
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len(r.text.encode()), n, n > 4096)


def test_cache_encodes_only_distinct_misses(spark, model, tmp_out):
    cache = f"{tmp_out}/cache"
    first = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None), (4, "")], "doc_id long, text string")
    token_counts.count_tokens(first, model, cache).collect()
    assert spark.read.parquet(cache).count() == 2  # the text, and the empty text
    more = first.union(spark.createDataFrame([(5, "three")], first.schema))
    rows = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(more, model, cache).collect()}
    assert spark.read.parquet(cache).count() == 3
    assert rows[1] == rows[2] > 0 and rows[3] == rows[4] == 0
    # another tokenizer version has entries of its own
    other = model.replace("piece_bpe_32k.model", "word_bpe_49k.json")
    token_counts.count_tokens(more, other, cache).collect()
    assert spark.read.parquet(cache).count() == 6
    # stored counts are used, and doubled entries do not double rows
    spark.read.parquet(cache).write.mode("append").parquet(cache)
    assert token_counts.count_tokens(more, model, cache).count() == 5


def test_json_tokenizer(spark, model, tmp_out):
    from tokenizers import Tokenizer

    path = model.replace("piece_bpe_32k.model", "byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = ["plain", "<|endoftext|> x", "é 😀", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path, f"{tmp_out}/c").collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_odd_rows_and_empty_table(spark, odd_docs, model, sp, tmp_out):
    want = sorted((str(r.doc_id), len(sp.encode(r.text or ""))) for r in odd_docs.collect())
    got = token_counts.count_tokens(odd_docs, model, f"{tmp_out}/c")
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == want
    enc = pieces.encode(odd_docs, model)
    assert sorted((str(r.doc_id), len(r.ids)) for r in enc.collect()) == want
    assert token_counts.count_tokens(odd_docs.limit(0), model, f"{tmp_out}/d").count() == 0
    assert pieces.encode(odd_docs.limit(0), model).count() == 0


def test_op2_equals_the_library(spark, docs, sp):
    got = {r.doc_id: r for r in queries.op2_sentencepiece(spark, SF).collect()}
    want = docs.collect()
    assert len(got) == len(want)
    for r in want:
        ids = sp.encode(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == sha(",".join(map(str, ids)))
        assert got[r.doc_id].decoded_sha256 == sha(sp.decode(ids))


def test_encode_odd_texts(spark, model, sp):
    r = random.Random(4)
    texts = ["", " ", "  ", "\n", " \n a", "▁▁x", "x▁ y ", "\t\tq", "a\r\nb  c", "<s>", "</s> <unk> <0x0A>", "\n\n\n", "x\n", "▁"]
    texts += ["".join(r.choice(" \n▁ab é😀\t.é") for _ in range(r.randint(1, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in pieces.encode(df, model).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t)
        assert (got[i].ids, got[i].decoded) == (ids, sp.decode(ids)), t


def test_each_chunk_is_segmented_once(spark, model, monkeypatch):
    m = pieces.Model(model)
    text = "the the the the"
    chunks = m.chunks(m.sp.normalize(text))
    assert chunks == ["▁the"] * 4 and m.segment(["▁the"])[0] * 4 == m.sp.encode(text)


def test_blocks_are_cut_by_size(spark, model, sp, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 50)
    df = spark.createDataFrame([(i, f"word{i % 3} and more words {i}") for i in range(60)], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in pieces.encode(df, model).collect()}
    assert got == {r.doc_id: sp.encode(r.text) for r in df.collect()}


def test_a_block_is_held_as_arrays(spark, model, sp, tmp_out):
    """Python objects for every id of a block once took most of an executor's memory."""
    sizes = f"{tmp_out}-sizes"

    def finish(m, table, positions):
        import sys

        n = len(table.ends) - 1 if hasattr(table, "ends") else len(table)
        with open(sizes, "a") as f:
            print(n, sum(sys.getsizeof(x) for x in table), file=f)
        return pieces._ids_and_text(m, table, positions)

    texts = [" ".join(f"w{i * 100 + k}" for k in range(100)) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.ids, r.decoded) for r in pieces.encode_documents(df, model, finish, "ids array<int>, decoded string").collect()}
    assert got == {i: (sp.encode(t), t) for i, t in enumerate(texts)}
    with open(sizes) as f:
        n, size = map(sum, zip(*(map(int, line.split()) for line in f)))
    assert n >= 20_000 and size < 48 * n


def test_entries_are_joined_whatever_their_length(monkeypatch):
    r = random.Random(6)
    entries = [np.array([r.randrange(99) for _ in range(r.choice([0, 1, 3, 200]))], "<i4") for _ in range(50)]
    table = pieces.Table.of([np.array([len(e) for e in entries])], entries, "<i4")
    at = np.array([r.randrange(50) for _ in range(400)], np.uint32)
    want = [i for k in at for i in entries[k].tolist()]
    monkeypatch.setattr(pieces, "STEP", 7)
    for long in (0, 32, 10**9):
        monkeypatch.setattr(pieces, "LONG", long)
        assert table.join(at).tolist() == want
    assert table.join(at[:0]).tolist() == []
    assert [e for some in table.lists() for e in some] == [e.tolist() for e in entries]
