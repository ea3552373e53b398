import glob
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.llm.helpers import documents, odd_rows, words
from tickframe.llm import bpe
from tickframe.llm import token_store as ts

public = pytest.importorskip("public_tokenizers")
BYTES, WORDS = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")
ODD = ["", " ", "  a", "a  b", "it's 's x 'll", "a\nb c", "a \n b", "<|endoftext|> x", "x  y",
       "foo!!, bar", "\0 a \0", "trail ", "A.B, c.", "don't. can't,", "\x1c a", "a  b",
       "x, , y", ", a", "é café", "Σίσυφος İstanbul", "1st 2nd. 3,000."]


def _model(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def test_piece_encoder_equals_the_library():
    model, encoder = _model(BYTES), ts.PieceEncoder(BYTES)
    texts = ODD + [t or "" for _, t in odd_rows()] + [" ".join(words(k, 300)) for k in range(5)]
    for _ in range(3):  # pieces come from the model, then from the table
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, np.int32).tolist() == model.encode(
                text, add_special_tokens=False).ids, repr(text)


def test_marks_after_marks_equal_the_library():
    model, encoder = _model(BYTES), ts.PieceEncoder(BYTES)
    batches = [["a etc. b", 'he said". so', "an end). so", "one word.. so", "x 12. y", "x Ω. y"],
               ["a etc. etc.. etc., b", 'he said", said". said". .', "an end).. end)., so",
                "one word... word..., so", "x 12.. 12., y", "x Ω.. Ω., y", "x é. é.. é., y"]]
    for k in (0, 1, 0, 1, 1):
        for text, ids in zip(batches[k], encoder.encode(batches[k]), strict=True):
            assert np.frombuffer(ids, np.int32).tolist() == model.encode(
                text, add_special_tokens=False).ids, repr(text)


def test_tables_of_pieces_stay_bounded_and_change_no_ids(monkeypatch):
    monkeypatch.setattr(ts, "KEPT_BYTES", 6000)
    monkeypatch.setattr(ts, "RECENT_BYTES", 4000)
    model, encoder = _model(BYTES), ts.PieceEncoder(BYTES)
    texts = [" ".join(w + "%" * (k % 3) for w in words(k, 60)) + "\nNext$$$ line.\nAnd \u00e9t\u00e9!!"
             for k in range(20)] + ["a\n\nb c", "x.\n1y z", "a b\n's", "it's\nll. don't,\nx"]
    for _ in range(3):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, np.int32).tolist() == model.encode(
                text, add_special_tokens=False).ids, repr(text)
            assert encoder.kept_bytes <= 6000 and encoder.recent_bytes < 4000 + 1000


def test_a_batch_is_read_in_slices():
    texts = ["x" * 40, None, "y" * 70, "", "\u00e9" * 30, None]
    batch = pa.record_batch([pa.array(range(6), pa.int64()), pa.array(texts, pa.string())],
                            ["doc_id", "text"]).slice(1)
    parts = list(ts._slices(batch, 65))
    assert [i for ids, _ in parts for i in ids] == [1, 2, 3, 4, 5]
    assert [t for _, part in parts for t in part] == ["", "y" * 70, "", "\u00e9" * 30, ""]
    assert len(parts) > 1 and list(ts._slices(batch.slice(5), 65)) == []


def test_bpe_composes_before_it_lowers(spark):
    texts = ["H\u0331", "a H\u0331 B", "J\u030c T\u0308 W\u030a Y\u030a", "ABC def"]
    got = {r.doc_id: r.ids for r in bpe.encode(documents(spark, list(enumerate(texts))),
                                               WORDS).select("doc_id", "ids").collect()}
    model = _model(WORDS)
    assert [got[k] for k in range(len(texts))] == [
        model.encode(t, add_special_tokens=False).ids for t in texts]


def _stored(spark, tmp_path, rows):
    path = str(tmp_path / "tokens")
    ts.write(documents(spark, rows), path, BYTES)
    return path


def test_token_store(spark, tmp_path):
    rows = odd_rows() + [(100 + k, t) for k, t in enumerate(ODD)]
    path = _stored(spark, tmp_path, rows)
    got = ts.checksums(ts.read(spark, path)).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    model, want = _model(BYTES), []
    for i, t in rows:
        tokens = model.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(
        want, key=str)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_token_files_are_selective(spark, tmp_path):
    path = _stored(spark, tmp_path, [(k, " ".join(words(k, 50))) for k in range(3000)])
    column = {}
    for file in glob.glob(path + "/*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        for k in range(group.num_columns):
            column[group.column(k).path_in_schema] = group.column(k)
    assert "DELTA_BINARY_PACKED" in column["doc_id"].encodings
    assert "RLE_DICTIONARY" in column["tokens.list.element"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in column.values())
    few = ts.read(spark, path, "doc_id", "n_tokens").where("doc_id = 7")
    plan = few._jdf.queryExecution().toString()
    assert few.count() == 1
    assert not re.search(r"\btokens#", plan.split("== Physical Plan ==")[1])


def test_empty_token_store(spark, tmp_path):
    assert ts.checksums(ts.read(spark, _stored(spark, tmp_path, []))).count() == 0


@pytest.mark.parametrize("chunk_bytes", [1, 1 << 20])
def test_bpe_round_trip(spark, chunk_bytes):
    rows = odd_rows() + [(100 + k, t) for k, t in enumerate(ODD)]
    encoded = bpe.encode(documents(spark, rows), WORDS, chunk_bytes=chunk_bytes)
    got = bpe.digests(encoded, WORDS).collect()
    model, want, texts = _model(WORDS), [], []
    for i, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids
        texts.append((i, model.decode(ids, skip_special_tokens=False)))
        want.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in
                                    (" ".join(map(str, ids)), texts[-1][1]))))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert sorted((tuple(r) for r in bpe.decode(encoded, WORDS).collect()), key=str) == sorted(
        texts, key=str)


def test_bpe_decodes_unknown_ids_as_the_library(spark):
    lists = [[], [320, 10 ** 6, 321, -1], [49407], None]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(df, WORDS).collect()}
    model = _model(WORDS)
    want = [model.decode([i for i in x or [] if 0 <= i < 10 ** 5], skip_special_tokens=False)
            for x in lists]
    assert [got[k] for k in range(4)] == want


def test_bpe_empty_table(spark):
    assert bpe.digests(bpe.encode(documents(spark, []), WORDS), WORDS).count() == 0
