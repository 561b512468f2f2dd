"""Text analytics and vector search on fixtures and against brute force."""

import itertools
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart import session
from tidemart.operators import chunks, sentiment, terms, vectors


def scores(spark, texts, lexicon=(("good", 1.9), ("great", 3.1), ("bad", -2.5), ("love", 3.2), ("kind", 2.4)), **rules):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    lex = spark.createDataFrame(list(lexicon), "token string, valence double")
    return {r["id"]: r for r in sentiment.lexicon_scores(df, lex, "id", "t", **rules).collect()}


def compound(total):
    return round(total / (total * total + 15) ** 0.5, 4)


def test_sentiment_rules(spark):
    texts = [
        None, "", "nothing here", "good", "very good", "not good", "good!!!", "GOOD food", "good but bad", "never so good", "kind of good",
        "at least good", "the least good", "really, very not good", "it is great??", "barely good", "isn't good",
    ]
    got = scores(spark, texts)
    assert (got[0]["neg"], got[0]["neu"], got[0]["pos"], got[0]["compound"], got[0]["sentiment_label"]) == (0.0, 1.0, 0.0, 0.0, "neutral")
    assert (got[1]["neg"], got[1]["neu"], got[1]["pos"], got[1]["compound"]) == (0.0, 0.0, 0.0, 0.0)
    assert got[2]["neu"] == 1.0 and got[2]["compound"] == 0.0
    assert got[3]["compound"] == compound(1.9) == 0.4404
    assert got[4]["compound"] == compound(1.9 + 0.293)
    assert got[5]["compound"] == compound(1.9 * -0.74)
    assert got[6]["compound"] == compound(1.9 + 3 * 0.292)
    assert got[7]["compound"] == compound(1.9 + 0.733)
    assert got[8]["compound"] == compound(1.9 * 0.5 - 2.5 * 1.5)
    assert got[9]["compound"] == compound((1.9 + 0.293) * 1.5)
    assert got[10]["compound"] == compound(1.9)
    assert got[11]["compound"] == compound(1.9)
    assert got[12]["compound"] == compound(1.9 * -0.74)
    assert got[13]["compound"] == compound(((1.9 * -0.74 - 0.293 * 0.95) - 0.293 * 0.9))
    assert got[14]["compound"] == compound(3.1 + 0.36)
    assert got[15]["compound"] == compound(1.9 - 0.293)
    assert got[16]["compound"] == compound(1.9 * -0.74)
    assert got[3]["pos"] == 1.0 and got[8]["sentiment_label"] == "negative"


def test_idioms(spark):
    texts = [
        "we all say cut the mustard good", "we all say yeah right good", "this is so kind of very good", "one two three kiss of death",
        "one two three good mood", "he said the bomb good", "good the bomb", "we all say Yeah right good", "one two three good the bomb",
    ]
    lexicon = (("good", 1.9), ("death", -2.9), ("bomb", -2.2), ("kind", 2.4))
    got = scores(spark, texts, lexicon, idioms={**sentiment.IDIOMS, "good the": 1.0, "good the bomb": 3.5})
    assert got[0]["compound"] == compound(2.0)  # what stands before the word
    assert got[1]["compound"] == compound(-2.0)
    assert got[2]["compound"] == compound((1.9 + 0.293) * 1.0)  # a known word three back: no idioms are looked for
    assert got[3]["compound"] == compound(-1.5)  # the word ends it
    assert got[4]["compound"] == compound(1.9)
    assert got[5]["compound"] == compound(3.0 + 3.0)  # it counts for the word that ends it and for the one behind it
    assert got[6]["compound"] == compound(1.9 - 2.2)  # too near the start
    assert got[7]["compound"] == compound(1.9)  # letter case counts
    assert got[8]["compound"] == compound(3.5 + 3.0)  # of two that begin here the longer one
    pair = scores(spark, ["it felt kind of all good", "it felt sort of good"], (("good", 1.9),))
    assert pair[0]["compound"] == pair[1]["compound"] == compound(1.9 - 0.293)


def test_long_lexicons_are_joined(spark):
    texts = [None, "", "very good, not bad", "GOOD food but bad", "he said yeah right good"]
    assert scores(spark, texts, map_words=1) == scores(spark, texts)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    lex = spark.createDataFrame([("good", 1.9), ("good", 0.5), (None, 1.0), ("bad", None)], "token string, valence double")
    plan = sentiment.lexicon_scores(df, lex, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan and "Window" not in plan
    assert scores(spark, ["good"], (("good", 1.9), ("good", 0.5)))[0]["compound"] == compound(1.9)


def test_add_sentiment(spark):
    df = spark.createDataFrame([(1, "Good"), (2, "Bad"), (3, None)], "id long, review_text string")
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    got = {r["id"]: r for r in sentiment.add_sentiment(df, "id", lexicon=lex).collect()}
    assert [got[i]["sentiment_label"] for i in (1, 2, 3)] == ["positive", "negative", "neutral"]

    @F.pandas_udf(T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())]))
    def model(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"label": ["POSITIVE" if t == "Bad" else "x" for t in texts], "score": [0.9 if t == "Bad" else None for t in texts]})

    got = {r["id"]: r for r in sentiment.add_sentiment(df, "id", lexicon=lex, method="scorer", scorer=model).collect()}
    assert got[2]["sentiment_score"] == 0.9 and got[2]["sentiment_label"] == "positive"
    assert got[1]["sentiment_label"] == "positive" and got[1]["sentiment_score"] == compound(1.9)
    with pytest.raises(ValueError):
        sentiment.add_sentiment(df, "id", "absent", lex)
    table = sentiment.headline_table(df.filter("id < 3"), lex, "id", "review_text").orderBy("id").collect()
    assert table[0]["headline_length"] == 4 and table[0]["compound"] == compound(1.9)


def test_preprocess(spark):
    df = spark.createDataFrame([(1, "Visit http://x.y/z now! The cats' toys don't work; cannot well-known a1 café"), (2, None)], "id long, review_text string")
    got = {r["id"]: r["review_text_preprocessed"] for r in terms.preprocess_texts(df, stop_words=["the", "now"]).collect()}
    assert got == {1: "visit cats toys do work can not café", 2: ""}
    lemmas = spark.createDataFrame([("cats", "cat"), ("toys", "toy")], "token string, lemma string")
    got = {r["id"]: r["review_text_preprocessed"] for r in terms.preprocess_texts(df, id_col="id", lemmas=lemmas, stop_words=["the", "now"]).collect()}
    assert got == {1: "visit cat toy do work can not café", 2: ""}
    assert len(terms.default_stop_words()) > 100
    with pytest.raises(ValueError):
        terms.preprocess_texts(df, "absent")


def test_phrases(spark):
    df = spark.createDataFrame([("the red fox a b",), ("red fox Red",), (None,), ("",)], "t string")
    got = [tuple(r) for r in terms.keywords(df, "t", 4, (1, 2), ["the"]).collect()]
    assert got == [("red", 3), ("fox", 2), ("red fox", 2), ("fox red", 1)]
    assert terms.common_phrases(df, "absent").count() == 0
    assert terms.common_phrases(df.filter("t = ''"), "t", stop_words=[]).count() == 0


@pytest.fixture(scope="module")
def corpus(spark):
    words = {"a": ["apple pear plum", "apple pear", "pear plum apple", "apple plum"], "b": ["dog cat cow", "cat cow", "dog cow cat", "dog cat"]}
    rows = [(f"{g}{i}", g, f"{t} filler{i % 2}") for g, ts in words.items() for i, t in enumerate(ts * 3)]
    rows += [("c1", "c", "lonely text here"), ("d1", "d", None)]
    return spark.createDataFrame(rows, "doc string, bank string, txt string").cache()


def test_topics(spark, corpus):
    weights = terms.tfidf(corpus, "doc", "txt", (), [])
    norms = weights.groupBy("doc").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r["n"] - 1) < 1e-9 for r in norms)
    errors = [terms.TopicModel(weights, [], "doc", 2, n).error().first()[0] for n in (0, 2, 8)]
    assert errors[0] > errors[1] > errors[2] >= 0
    x = weights.toPandas().pivot(index="doc", columns="term", values="weight").fillna(0)
    model = terms.TopicModel(weights, [], "doc", 2, 8)
    w, h = model.w.toPandas().set_index("doc").loc[x.index], model.h.toPandas().set_index("term").loc[x.columns]
    assert (w.values >= 0).all() and (h.values >= 0).all()
    assert ((x.values - w.values @ h.values.T) ** 2).sum() == pytest.approx(errors[2])
    top = terms.topics(corpus, "doc", "txt", 2, 3, 8, []).collect()
    found = {frozenset(r["term"] for r in top if r["topic"] == t) for t in (0, 1)}
    assert found == {frozenset(["apple", "pear", "plum"]), frozenset(["dog", "cat", "cow"])}


def test_themes(corpus):
    got = {r["bank"]: r["themes"] for r in terms.themes_by_group(corpus, "doc", "txt", "bank", 2, 3, 3, []).collect()}
    assert len(got["a"]) == 2 and all(len(t) == 3 for t in got["a"])
    assert got["c"] == [["here"], ["lonely"]] and got["d"] == []


def test_chunks_keep_the_text(spark):
    rng = np.random.default_rng(3)
    words = lambda n: " ".join("w" * int(k) for k in rng.integers(1, 12, n))
    texts = [words(400), words(40) + "\n\n" + words(300) + "\n" + words(20) + ". " + words(90), "x" * 1300, "short", "  ", ". ".join([words(30)] * 20)]
    for text in texts:
        out = chunks.split_text(text, 100, 20)
        assert all(0 < len(c) <= 100 for c in out)
        assert set("".join(text.split())) == set("".join("".join(out).split()))
        for piece in text.replace(".", " ").split():
            assert len(piece) > 100 or any(piece in c for c in out)
    assert chunks.split_text("short", 100, 20) == ["short"] and chunks.split_text(" ", 100, 20) == []
    assert chunks.split_text("a b c d", 3, 0) == ["a b", "c", "d"]
    assert chunks.split_text("aaaa bbbb cccc", 10, 5) == ["aaaa bbbb", "bbbb cccc"]
    assert chunks.split_text("x" * 25, 10, 4) == ["x" * 10, "x" * 10, "x" * 10, "x" * 7]
    df = spark.createDataFrame([(7, "p", "one\n\ntwo"), (8, "p", "  "), (9, "q", None), (None, "q", "z")], "id int, Product string, cleaned_narrative string")
    rows = chunks.create_chunks(df, "id", size=4, overlap=0).orderBy("complaint_id", "chunk_index").collect()
    assert [(r["complaint_id"], r["text"], r["chunk_index"]) for r in rows] == [("7", "one", 0), ("7", "two", 1), ("unknown", "z", 0)]
    again = chunks.create_chunks(df.repartition(3), "id", size=4, overlap=0).collect()
    assert {r["chunk_id"] for r in again} == {r["chunk_id"] for r in rows}


@pytest.mark.parametrize("block_bytes,batch_bytes", [(1 << 26, 1 << 25), (400, 900)])
def test_neighbours_against_brute_force(spark, monkeypatch, block_bytes, batch_bytes):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(vectors, "BATCH_BYTES", batch_bytes)
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(0, 1, (120, 4)), 1).astype("float32")
    points[50:60] = points[0]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(999, None)], "vec_id long, embedding array<float>").repartition(6)
    queries = df.filter("vec_id < 25").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in vectors.knn_join(queries, df, 4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["distance"])
    exact = points.astype("float64")
    for q in range(25):
        d = ((exact - exact[q]) ** 2).sum(1)
        want = sorted(range(120), key=lambda i: (d[i], i))[:4]
        assert [got[q][k][0] for k in (1, 2, 3, 4)] == want
        assert [got[q][k][1] for k in (1, 2, 3, 4)] == pytest.approx([d[i] for i in want])
    assert vectors.knn_join(queries.filter("false"), df, 4).count() == 0


def test_contexts(spark):
    near = spark.createDataFrame([(1, 2, "b\nb"), (1, 1, "a" * 50)], "query_id long, rank int, text string")
    asked = vectors.contexts(near, spark.createDataFrame([(1, "why?"), (2, "who?")], "query_id long, question string"))
    rows = {r["query_id"]: r for r in asked.collect()}
    assert f"Excerpt 1: {'a' * 50}\n\nExcerpt 2: b\nb" in rows[1]["prompt"] and rows[1]["prompt"].endswith("Question: why?\n\nAnswer:")
    shown = {r["Question"]: r["Sources Shown"] for r in vectors.evaluation_table(asked).collect()}
    assert shown == {"why?": f"[1] {'a' * 37}... | [2] b b", "who?": "None"}


def test_sentiment_tokens(spark):
    df = spark.createDataFrame([("Good!! 'bad' a ok. ...nice well-known, (x)",)], "t string")
    got = df.select(sentiment.sentiment_tokens(F.col("t"))).first()[0]
    assert got == ["Good", "'bad'", "ok", "...nice", "well-known,", "(x)"]


def test_ngram_lists(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), ([],)], "x array<string>")
    got = [r[0] for r in df.select(terms.ngrams(F.col("x"), 1, 3)).collect()]
    assert got[0] == ["a", "b", "c", "a b", "b c", "a b c"] and got[1] == []
    assert list(itertools.chain(*[r[0] for r in df.select(terms.ngrams(F.col("x"), 2, 2)).collect()])) == ["a b", "b c"]


@pytest.mark.parametrize("method", [None, "no such method", "scorer"])
def test_any_other_method_means_the_lexicon(spark, method):
    df = spark.createDataFrame([(1, "a good day"), (2, "bad"), (3, None)], "id long, review_text string")
    words = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    by_lexicon = sentiment.add_sentiment(df, "id", lexicon=words).orderBy("id").collect()
    assert sentiment.add_sentiment(df, "id", lexicon=words, method=method).orderBy("id").collect() == by_lexicon
    assert [row["sentiment_label"] for row in by_lexicon] == ["positive", "negative", "neutral"]


def test_long_phrases_are_counted_only_where_their_words_are_frequent(spark, monkeypatch):
    texts = ["a1 b1 c1 a1 b1", "a1 b1 x1 y1", "c1 a1 b1 z1", "q1 r1 q1 r1", "a1 c1", "b1 c1 x1", "q1"]
    df = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "t string")
    asked = []
    count = terms.phrase_counts
    monkeypatch.setattr(terms, "phrase_counts", lambda *args, **kw: asked.append(args[3]) or count(*args, **kw))
    for grams in ((1, 2), (1, 3), (2, 3)):
        every = count(df, "t", (), grams, []).collect()
        for n in (1, 2, 4, 7, 500):
            want = sorted(((r["phrase"], r["count"]) for r in every), key=lambda r: (-r[1], r[0]))[:n]
            assert [tuple(r) for r in terms.common_phrases(df, "t", n, grams, []).collect()] == want
    monkeypatch.setattr(terms, "FREQUENT", 3)
    assert [tuple(r) for r in terms.common_phrases(df, "t", 3, (1, 2), []).collect()] == sorted(((r["phrase"], r["count"]) for r in count(df, "t", (), (1, 2), []).collect()), key=lambda r: (-r[1], r[0]))[:3]


def test_rare_bigrams_are_not_shuffled(spark):
    texts = ["top1 top2 " + f"rare{i} rarer{i}" for i in range(300)]
    out = terms.common_phrases(spark.createDataFrame([(t,) for t in texts], "t string"), "t", 2, (1, 2), [])
    assert [tuple(r) for r in out.collect()] == [("top1", 300), ("top1 top2", 300)]
    assert "filter(" in out._jdf.queryExecution().optimizedPlan().toString() and "top2" in out._jdf.queryExecution().optimizedPlan().toString()


def test_weights_take_three_shuffles_of_document_terms(spark):
    df = spark.createDataFrame([(1, "aa bb bb"), (2, "aa cc"), (2, "cc bb"), (3, "bb aa")], "d long, t string")
    out = terms.tfidf(df, "d", "t", (), [], 1.0, 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and plan.count("Exchange hashpartitioning(d") == 1
    norms = out.groupBy("d").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(r["n"] == pytest.approx(1.0) for r in norms) and len(norms) == 3


def test_texts_are_cut_in_slices_of_a_batch(spark, monkeypatch):
    texts = [(i, ("word " * (i % 40)) + "." + "x" * (700 * (i % 2)), "p") for i in range(150)]
    df = spark.createDataFrame(texts, "id long, t string, p string").coalesce(1)
    got = {(int(r["complaint_id"]), r["chunk_index"]): r["text"] for r in chunks.create_chunks(df, "id", "t", "p", 60, 10).collect()}
    want = {(i, place): chunk for i, text, _ in texts for place, chunk in enumerate(chunks.split_text(text, 60, 10))}
    assert got == want
    plan = chunks.create_chunks(df, "id", "t", "p")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_blocks_of_a_factorisation_add_up(spark, corpus, monkeypatch):
    monkeypatch.setattr(terms, "BLOCK_ENTRIES", (5, 9))
    monkeypatch.setattr(terms, "BLOCK_TERMS", (2, 2))
    plans, write = [], terms.materialize
    monkeypatch.setattr(terms, "materialize", lambda df, tag="cut": plans.append((tag, df._jdf.queryExecution().executedPlan().toString())) or write(df, tag))
    weights = write(terms.tfidf(corpus, "doc", "txt", ["bank"], []).filter("bank in ('a', 'b')"), "weights")
    start, model = (terms.TopicModel(weights, ["bank"], "doc", 2, n, tolerance=0) for n in (0, 3))
    assert model.cells.count() > 8 and model.rounds == 3
    for bank in ("a", "b"):
        x = weights.filter(F.col("bank") == bank).toPandas().pivot(index="doc", columns="term", values="weight").fillna(0)
        part = lambda f, own, ids, name: f.filter(F.col("bank") == bank).toPandas().set_index(own).loc[ids][[f"{name}0", f"{name}1"]].to_numpy()
        w, h = part(start.w, "doc", x.index, "w"), part(start.h, "term", x.columns, "h")
        for _ in range(3):
            w = w * (x.values @ h) / (w @ (h.T @ h) + terms.EPSILON)
            h = h * (x.values.T @ w) / (h @ (w.T @ w) + terms.EPSILON)
        assert part(model.w, "doc", x.index, "w") == pytest.approx(w) and part(model.h, "term", x.columns, "h") == pytest.approx(h)
    # a round moves what blocks send each other, once to documents and once to terms; the cells stay where they are
    rounds = [plan for tag, plan in plans if tag == "factors"][-3:]
    assert all(plan.count("FlatMapCoGroupsInPandas") == plan.count("ENSURE_REQUIREMENTS") == 2 and "Join" not in plan for plan in rounds)


def test_a_factorisation_keeps_one_state_and_no_shuffles(spark, corpus, monkeypatch):
    folders = lambda: Counter(p.name.split("-")[0] for p in Path(session.shared_dir(spark), spark.sparkContext.applicationId).glob("*-*"))
    before, seen, write = folders(), [], terms.materialize

    def watched(df, tag="cut"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((tag, plan.count("ENSURE_REQUIREMENTS"), spark.conf.get(session.SHUFFLES_END)))
        return write(df, tag)

    monkeypatch.setattr(terms, "materialize", watched)
    with session.settings(spark, spark__sql__shuffle__partitions=20):  # more than there are blocks
        terms.topics(corpus, "doc", "txt", 2, 3, 5, []).collect()
        terms.themes_by_group(corpus, "doc", "txt", "bank", 2, 3, 5, []).collect()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8" and spark.conf.get(session.SHUFFLES_END) == "false"
    left = folders() - before
    assert left["factors"] == 2 and left["cells"] == 2 and left["tf"] == left["idf"] == left["weights"] == 0  # one of each model
    rounds = [s for s in seen if s[0] == "factors"]
    assert {s[2] for s in rounds} == {"true"} and [s[1] for s in rounds].count(2) == len(rounds) - 2  # all but the starts
    assert not spark.catalog.listTables()


def test_weights_and_cells_made_in_parts(spark, corpus, monkeypatch):
    ways = []
    for rows in (1 << 22, 3):
        monkeypatch.setattr(terms, "PART_ROWS", rows)
        weights = terms.tfidf(corpus, "doc", "txt", ["bank"], [], store=True)
        assert sorted(weights.collect()) == sorted(terms.tfidf(corpus, "doc", "txt", ["bank"], []).collect())
        model = terms.TopicModel(weights, ["bank"], "doc", 2, 3, spent=weights)
        ways.append([sorted(model.w.collect()), sorted(model.h.collect()), model.error().first()[0]])
    names, values = zip(*([[tuple(v for v in r if not isinstance(v, float)) for r in w + h], [v for r in w + h for v in r if isinstance(v, float)] + [e]] for w, h, e in ways), strict=True)
    assert names[0] == names[1] and values[0] == pytest.approx(values[1]) and len(values[0]) > 50


def test_shuffle_files_go_when_a_part_is_written(spark):
    files = lambda: {p for folder in local for p in Path(folder).rglob("shuffle_*.data")}
    local = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    before = files()
    part = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    got, until = session.written([part, part], "test"), time.monotonic() + 20
    while files() - before and time.monotonic() < until:  # other threads delete them
        time.sleep(0.2)
    assert not files() - before and got.count() == 14
    session.drop_cut(got)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        got.collect()


def test_sentiment_makes_no_row_per_word(spark):
    df = spark.createDataFrame([(1, "GOOD food, very bad!"), (2, None), (3, "")], "id long, t string")
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    out = sentiment.lexicon_scores(df, lex, "id", "t")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    folds = [line for line in plan.splitlines() if "aggregate(" in line]
    assert len(folds) == 1 and folds[0].count("aggregate(") == 4 and "struct" not in folds[0]
    assert plan.count("(upper(") == 1  # capitals are found once a word
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["compound"] == compound(1.9 + 0.733 - 2.5 - 0.293 - 0.292) and got[2]["neu"] == 1.0 and got[3]["neu"] == 0.0
    assert scores(spark, ["one two kind bad", "x y kind of bad", "kind of"], (("bad", -2.5),), idioms={}, dampening_pairs=())[1]["compound"] == compound(-2.5)
