"""Tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemart.llm import alignment, vocab

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*map(vocab.vocabulary_path, (vocab.BYTE_BPE, vocab.PIECE_BPE)))


def brute(docs):
    """Rows as the definition has them, with both libraries alone."""
    byte_library = Tokenizer.from_file(vocab.vocabulary_path(vocab.BYTE_BPE))
    byte_library.encode_special_tokens = True
    piece_library = sentencepiece.SentencePieceProcessor(model_file=vocab.vocabulary_path(vocab.PIECE_BPE))
    spelt = {character: byte for byte, character in vocab.byte_characters().items()}
    tokens, links = [], []
    for _, text in docs:
        a, b = [], []
        if text:
            encoded = byte_library.encode(" " + text, add_special_tokens=False)
            a = [(number, bytes(spelt[c] for c in token)) for number, token in zip(encoded.ids, encoded.tokens, strict=True)]
            for number in piece_library.encode(text):
                piece = piece_library.id_to_piece(number)
                b.append((number, bytes([int(piece[3:5], 16)]) if piece_library.is_byte(number) else piece.replace("▁", " ").encode()))
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
                a, b = [], []
        tokens.append((a, b))
        ranges = []
        for side in (a, b):
            at, own = 0, []
            for number, data in side:
                own.append((number, at, at + len(data)))
                at += len(data)
            ranges.append(own)
        links.append([(x[0], y[0]) for x in ranges[0] for y in ranges[1] if max(x[1], y[1]) < min(x[2], y[2])])
        tokens[-1] = ranges
    counts = Counter(link for own in links for link in own)
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(n, highest.get(y, 0))
    rows = []
    for (key, _), (a, b), own in zip(docs, tokens, links, strict=True):
        ends = sorted({end for _, _, end in a} & {end for _, _, end in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(n) for n, s, e in side if s >= start and e <= end) for side in (a, b)))
            start = end
        text = ";".join(groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        rows.append((key, len(a), len(b), len(groups), len(own), sum(counts[x] == highest[x[1]] for x in own), sum(counts[x] for x in own), digest, text))
    return sorted(rows, key=repr)


def test_rows_are_those_of_brute_force(spark, monkeypatch):
    odd = [
        (1, None), (2, ""), (3, "a ▁ b"), (4, "<|endoftext|> <s> x</s> <unk>"), (5, "  two  blanks \n\n\t end  "), (6, "héé naïve 漢字 🙂🙂 \x00 ‍"),
        (6, "héé naïve 漢字 🙂🙂 \x00 ‍"), (None, "no id"), (None, "no id"), (7, "\n" * 1200 + "x" + " " * 1100), (8, "ꬰ𞤀𖹀ᲀ new letters Ა 𑻠"), (9, "aaaa" * 300), (10, "\x1c\x85\xa0 　x \r\n"),
        (11, "don't they'll I'M 12345 6,789.10"),
    ]
    given = [tuple(row) for row in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40).collect()]
    given = [(key, text[:1500]) for key, text in given]
    docs = spark.createDataFrame([(key, text, 1, "x") for key, text in odd + given], "doc_id long, text string, chunk int, data string").repartition(3)
    got = alignment.align_documents(docs, groups=True).collect()
    assert sorted(map(tuple, got), key=repr) == brute(odd + given)


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = sorted(map(tuple, alignment.align_documents(docs).collect()))
    assert len(whole) == docs.count()
    cut = alignment.aligned_chunks(docs.repartition(5))
    assert cut.filter("not is_document").count() == 5
    assert sorted(map(tuple, alignment.align_documents(docs.repartition(5)).collect())) == whole


def test_empty_table(spark):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def test_pairs_are_counted_over_all_documents(spark):
    docs = spark.createDataFrame([(key, "the tide") for key in range(30)], "doc_id long, text string").repartition(4)
    counts = alignment.pair_counts(alignment.aligned_chunks(docs)).collect()
    assert {row["count"] for row in counts} == {30} and all(row.best for row in counts)


def test_stretches_groups_and_overlaps():
    draw = random.Random(3)
    for _ in range(4000):
        size = draw.choice([8, 40, 150])
        a, b = (sorted({*draw.sample(range(1, size + 1), draw.randint(1, size)), size}) for _ in range(2))
        if draw.random() < 0.5:
            b = [end for end in a if draw.random() < 0.97 or end == size]
        aligned = alignment.align(a, b)
        assert [a[i - 1] for i in aligned.starts()[0][1:]] + [size] == sorted(set(a) & set(b)) == [b[j - 1] for j in aligned.starts()[1][1:]] + [size]
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in aligned.stretches)
        first, second = aligned.overlaps()
        wanted = [(x, y) for x in range(len(a)) for y in range(len(b)) if max(([0] + a)[x], ([0] + b)[y]) < min(a[x], b[y])]
        assert sorted(zip(first.tolist(), second.tolist(), strict=True)) == wanted


def test_a_long_stretch_is_jumped_in_few_probes():
    class Counted(list):
        slices = 0

        def __getitem__(self, at):
            Counted.slices += isinstance(at, slice)
            return list.__getitem__(self, at)

    ends = Counted(range(1, 100_001))
    aligned = alignment.align(ends, list(ends))
    assert aligned.stretches.tolist() == [[0, 0, 100_000]] and not len(aligned.groups) and not len(aligned.crossed)
    assert Counted.slices < 60


def test_texts_that_the_pieces_spell_otherwise_have_no_tokens(pair):
    assert [len(ids) for ids in pair.ids("a ▁ b")] == [0, 0]
    assert len(pair.ids("<|endoftext|>")[0]) > 1
