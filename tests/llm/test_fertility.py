import random

import numpy as np
from pyspark.sql import functions as F

from tidemart.llm import fertility as ft
from tidemart.llm import vocab


def words_in(text):
    out, word = [], ""
    for character in text:
        if character in " \t\n\v\f\r":
            out += [word] if word else []
            word = ""
        else:
            word += character
    return out + ([word] if word else [])


def base(text):
    """The base rules, plainly."""
    words = words_in(text)
    lines = [line for line in text.split("\n") if words_in(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + j for i, window in enumerate(windows) if windows.count(window) > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def fertility(text):
    encode = vocab.rank_encoder(vocab.vocabulary_path(vocab.BYTE_BPE_RANKS)).encode_ordinary
    pieces = vocab.piece_encoder(vocab.vocabulary_path(vocab.PIECE_BPE))
    words = words_in(text)
    ids = [token for word in words for token in encode(" " + word)]
    characters = "".join(words)
    spelt = [any(pieces.is_byte(piece) for piece in pieces.encode(character)) for character in characters]
    counts = np.array([ids.count(token) for token in set(ids)]) / max(1, len(ids))
    spread = -(counts * np.log2(counts)).sum() / np.log2(min(len(ids), ft.SPREAD_TOKENS)) if len(ids) > 1 else 1.0
    return len(characters) / len(ids) if ids else 0.0, sum(spelt) / len(characters) if characters else 0.0, spread


def texts():
    rng = random.Random(7)
    pool = ["the", "of", "thing,", "é", "word.", "##", "ünder", "漢字", "a|b", " ", "x\xa0y", "\x1c", "🙂"]
    out = ["", " \n ", "one", "a\n\na\na", "\n".join(["same line of words here"] * 30)]
    for _ in range(60):
        words = rng.choices(pool, k=rng.randint(0, 120))
        if rng.random() < 0.4 and len(words) > 10:
            words += words[: rng.randint(7, 12)]
        out.append("".join(word + rng.choice([" ", " ", "\n", "\t", "  "]) for word in words))
    return out


def test_measures_equal_brute_force(spark):
    rows = [(i, text, None) for i, text in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for r in ft.judge_documents(docs).collect():
        counts = base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == counts
        per_token, share, spread = fertility(r["text"])
        assert np.allclose([r["chars_per_token"], r["byte_share"], r["token_entropy"]], [per_token, share, spread])
        band = ft.DEFAULT_BANDS.of(None, r["script"])
        fits = band.low <= per_token <= band.high and share <= band.byte_share and spread >= band.entropy
        assert r["kept"] == (fits and not r["base_failed"])


def test_good_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = ft.judge_documents(docs).filter("not base_failed").groupBy("quality", "kept").count().collect()
    seen = {(r["quality"], r["kept"]): r["count"] for r in rows}
    assert seen.get((1, False), 0) == 0 and seen.get((0, False), 0) > 0


def test_bands_by_language_and_script():
    bands = ft.Bands({"de": ft.Band(1.0)}, {"latin": ft.Band(2.0)}, ft.Band(3.0))
    assert [bands.of(*key).low for key in (("de", "latin"), ("en", "latin"), (None, "thai"))] == [1.0, 2.0, 3.0]
    assert ft.script_of(ft.scripts_in("слово и word")) == "cyrillic" and ft.script_of(ft.scripts_in("123")) == "none"
    assert {row["name"] for row in ft.bands_as_rows(bands)} == {"de", "latin", ""}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None), (None, "", "en"), (2, "a", "en"), (2, "a", "en")], "doc_id long, text string, lang string")
    docs = docs.withColumn("KEPT", F.lit("own")).withColumn("n_words", F.lit(9))
    rows = ft.judge_documents(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in rows) == [(0, 0, False), (1, 0, False), (2, 1, False), (2, 1, False)]
    assert ft.judge_documents(docs.limit(0)).collect() == []
    assert ft.keep_fitting(docs).columns == docs.columns and ft.keep_fitting(docs).collect() == []
