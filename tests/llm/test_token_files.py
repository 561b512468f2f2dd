import json
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm import files, token_files, vocab

TEXTS = [
    "", " ", "a", "\na", "a\n", "a b\nc d", "it's a\ntest's\n'll we", "x 12 34\n56 !!\n!! a", "é b c", "<|endoftext|> a\n<|endoftext|>", "a  b c", "a\x1cb c d",
    "tab\there and nbsp\xa0there", "word, word. word; (word) word-word", "漢字 かな\n한글 🙂🙂", "\x01 a \x01b", "a" * 300 + " " + "b" * 70, "ends with mark.\n\nnew",
]


@pytest.fixture(scope="module")
def encoder():
    return vocab.byte_encoder(vocab.vocabulary_path(vocab.BYTE_BPE))


def test_texts_give_the_library_s_ids(encoder):
    for _ in range(2):
        for text in TEXTS:
            assert encoder.ids(text).tobytes() == encoder.whole(text), text


def test_given_texts_give_the_library_s_ids(encoder, spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert encoder.ids(row["text"]).tobytes() == encoder.whole(row["text"])


def test_added_tokens_have_the_library_s_ids(encoder, spark, folder):
    path = vocab.vocabulary_path(vocab.BYTE_BPE)
    fresh = Tokenizer.from_file(path)
    texts = [*TEXTS, "a <|endoftext|> b", "<|endoftext|>", "word<|endoftext|>word", "a <|endoftext b|>"]
    expected = {text: fresh.encode(text, add_special_tokens=False).ids for text in texts}
    assert 50256 in expected["a <|endoftext|> b"]
    assert {text: encoder.ids(text).tolist() for text in texts} == expected
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = token_files.read_token_files(spark, token_files.write_token_files(docs, folder)).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: [*expected[text], 2] for i, text in enumerate(texts)}


def test_without_rank_file_and_with_odd_characters(encoder, folder):
    os.symlink(vocab.vocabulary_path(vocab.BYTE_BPE), f"{folder}/{vocab.BYTE_BPE}")
    alone = vocab.ByteEncoder(f"{folder}/{vocab.BYTE_BPE}")
    assert alone.ranked is None
    other = vocab.ByteEncoder(vocab.vocabulary_path(vocab.BYTE_BPE))
    other.differing.add("漢")
    for text in [*TEXTS, " " * 1200 + "x\n" * 3, "漢 is odd", "\u180e\u200b\ufeff x\u0378 𖹀ᲀ"]:
        assert alone.ids(text).tobytes() == other.ids(text).tobytes() == encoder.ids(text).tobytes() == encoder.whole(text)


def expected(rows, encoder, end_id=2):
    start, out = 0, []
    for key, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        ids = np.append(np.frombuffer(encoder.whole(text or ""), "<u4"), np.uint32(end_id)).astype("<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    return out


def test_round_trip(spark, folder, encoder):
    rows = [(1000 - 7 * i, text) for i, text in enumerate(TEXTS * 4)] + [(None, "no key"), (5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("start", F.lit("own"))
    manifest = token_files.write_token_files(docs, folder)
    got = sorted((tuple(r) for r in token_files.read_token_files(spark, manifest).collect()), key=lambda r: r[1])
    assert [(r[0], r[1], r[2], r[3], list(r[4])) for r in got] == expected(rows, encoder)
    found = json.loads(files.read(manifest))
    whole = np.concatenate([files.mapped(f"{part['stem']}.tokens", np.dtype(found["kind"])) for part in found["parts"]])
    assert whole.tolist() == [token for row in got for token in row[4]] and found["n_tokens"] == len(whole)
    ends = [files.mapped(f"{part['stem']}.offsets", np.dtype("<i8")) for part in found["parts"]]
    assert all(a[-1] == b[0] for a, b in zip(ends, ends[1:], strict=False)) and ends[-1][-1] == len(whole)


def test_repeated_rows_and_empty_tables(spark, folder, encoder):
    rows = [(3, "same"), (3, "same"), (3, "other"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_files.read_token_files(spark, token_files.write_token_files(docs, f"{folder}/a")).collect()
    lengths = sorted(row[2] for row in expected(rows, encoder))
    assert sorted(r["n_tokens"] for r in got) == lengths
    assert sorted(r["start"] for r in got)[0] == 0 and max(r["start"] + r["n_tokens"] for r in got) == sum(lengths)
    empty = token_files.write_token_files(docs.limit(0), f"{folder}/b")
    assert token_files.read_token_files(spark, empty, ids=False).collect() == []


def test_kind_follows_the_vocabulary():
    assert token_files.number_kind(50_257) == np.dtype("<u2") and token_files.number_kind(1 << 16) == np.dtype("<u4")
