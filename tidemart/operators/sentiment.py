"""Lexicon sentiment with the published valence rules, worked out inside each row over arrays of its tokens."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numeric import clamp
from tidemart.functions.text import headline_features, sentiment_label, signed_score, whitespace_words
from tidemart.session import spread

# Fixed values of the published rules.
BOOST, CAPS, NEGATION, ALPHA = 0.293, 0.733, -0.74, 15.0
BOOSTERS = (
    "absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely especially exceptionally "
    "extremely fabulously flipping flippin fricking frickin frigging friggin fully fucking greatly hella highly hugely incredibly "
    "intensely majorly more most particularly purely quite really remarkably so substantially thoroughly totally tremendously uber "
    "unbelievably unusually utterly very"
).split()
DAMPENERS = (
    "almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely slightly somewhat sorta sortof sort-of"
).split()
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont hadnt hasnt havent isnt "
    "mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor not nothing nowhere "
    "oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely "
    "seldom despite"
).split()
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0, "kiss of death": -1.5, "hand to mouth": -2.0,
}
DAMPENING_PAIRS = ("kind of", "sort of")
# One of these marks on one side of a word is cut off.
EDGE_MARKS = r"(?:\?!\?!|!\?!\?|\?!\?|!\?!|!!!|\?\?\?|!!|\?\?|[.!?,;:\-'\"])"
EDGES = ".!?,;:-'\""
PLAIN = r"[^!-/:-@\[-`{-~]{2,}"

#: A lexicon of up to this many words is a constant of the plan (some 30 bytes a word); a longer one is joined.
MAP_WORDS = 50_000

LEXICON_METHOD, SCORER_METHOD = "lexicon", "scorer"


def sentiment_tokens(c: Column) -> Column:
    """Whitespace tokens of two or more characters, one punctuation mark cut from one side."""
    edged = rf"^(?:{EDGE_MARKS}({PLAIN})|({PLAIN}){EDGE_MARKS})$"
    long = F.filter(whitespace_words(c), lambda t: F.length(t) > 1)
    # The pattern walks back through a whole word; most words have no mark at either end.
    return F.transform(long, lambda t: F.when(F.btrim(t, F.lit(EDGES)) == t, t).otherwise(F.regexp_replace(t, edged, "$1$2")))


def _upper(t: Column) -> Column:
    return (F.upper(t) == t) & (F.lower(t) != t)


def _constant_map(pairs: Mapping[str, float]) -> Callable[[Column], Column]:
    """Look-up in a constant of the plan: one small map per hash slot, as a look-up walks through the map it is in."""
    slots: list[dict[str, float]] = [{} for _ in range(max(1, len(pairs)))]
    for word, value in pairs.items():
        slots[zlib.crc32(word.encode()) % len(slots)][word] = value
    constant = F.from_json(F.lit(json.dumps(slots)), "array<map<string,double>>")
    return lambda word: F.try_element_at(F.get(constant, (F.crc32(word) % len(slots)).cast("int")), word)


def _with_bases(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, map_words: int) -> DataFrame:
    """`df` with its tokens, the same in lower case, and each one's own valence (null if it has none)."""
    words = F.col("__words")
    tokens = spread(df).withColumn("__words", sentiment_tokens(F.col(text_col))).withColumn("__low", F.transform(words, F.lower))
    values = lexicon.select("token", F.col("valence").cast("double").alias("base")).dropna().groupBy("token").agg(F.max("base").alias("base"))
    known = values.limit(map_words + 1).collect()
    if len(known) <= map_words:
        base = _constant_map({row["token"]: row["base"] for row in known})
        return tokens.withColumn("__bases", F.transform("__low", base))
    # More words than a constant should hold. Outer: a plain explode makes the optimizer evaluate the tokens again in a filter.
    rows = tokens.select(id_col, F.posexplode_outer("__low").alias("pos", "token")).filter("token is not null").join(values, "token", "left")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda t: t["base"])
    return tokens.join(rows.groupBy(id_col).agg(ordered.alias("__bases")), id_col, "left")


def _with_valences(
    df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str,
    boosters: Sequence[str] = BOOSTERS, dampeners: Sequence[str] = DAMPENERS, negations: Sequence[str] = NEGATIONS,
    idioms: Mapping[str, float] = IDIOMS, dampening_pairs: Sequence[str] = DAMPENING_PAIRS, map_words: int = MAP_WORDS,
) -> DataFrame:
    """`df` with `__valences`: every token's valence after capitals, boosters, negation, idioms, 'least' and 'but'.

    Each rule is one pass over the array of valences that looks at the neighbours in the arrays of words, and
    only where a word has a valence of its own.
    """
    facts = _with_bases(df, lexicon, id_col, text_col, map_words)
    facts = facts.withColumn("__caps", F.transform("__words", _upper))
    facts = facts.withColumns({
        "__mixed": F.exists("__caps", lambda c: c) & F.exists("__caps", lambda c: ~c), "__but": F.array_position("__low", "but"),
        "__boosts": F.transform("__low", lambda w: F.when(w.isin(list(boosters)), BOOST).when(w.isin(list(dampeners)), -BOOST)),
        "__negates": F.transform("__low", lambda w: w.isin(list(negations)) | F.contains(w, F.lit("n't"))),
    })
    word, low, boost, negates = (lambda i, name=name: F.get(name, i) for name in ("__words", "__low", "__boosts", "__negates"))
    caps = lambda i: F.col("__mixed") & F.get("__caps", i)
    so = lambda i: word(i).isin("so", "this")
    sign = lambda v: F.when(v > 0, 1.0).otherwise(-1.0)
    plain = lambda v, i, j: v.isNotNull() & (i >= j) & F.get("__bases", i - j).isNull()

    v = F.transform("__bases", lambda v, i: F.when(v.isNotNull() & caps(i), v + sign(v) * CAPS).otherwise(v))

    def looked_back(valences: Column, j: int, fade: float, lift: float) -> Column:
        def rule(v: Column, i: Column) -> Column:
            push = boost(i - j) * F.when(v < 0, -1.0).otherwise(1.0) + F.when(caps(i - j), sign(v) * CAPS).otherwise(0.0)
            never = {
                1: F.lit(False),
                2: (word(i - 2) == "never") & so(i - 1),
                3: ((word(i - 3) == "never") & so(i - 2)) | so(i - 1),
            }[j]
            factor = F.when(never, lift).when(negates(i - j), NEGATION).otherwise(1.0)
            return F.when(plain(v, i, j), (v + F.coalesce(push, F.lit(0.0)) * fade) * factor).otherwise(v)

        return F.transform(valences, rule)

    for j, fade, lift in ((1, 1.0, 1.0), (2, 0.95, 1.5), (3, 0.9, 1.25)):
        v = looked_back(v, j, fade, lift)
    if idioms or dampening_pairs:
        phrase = lambda *places: F.concat(*[part for place in places for part in (F.lit(" "), word(place))][1:])
        looked_up, pairs = _constant_map(idioms), list(dampening_pairs)
        firsts = lambda phrases: sorted({p.split(" ")[0] for p in phrases})
        # Few words begin a phrase, so few phrases are put together.
        value = lambda *places: F.when(word(places[0]).isin(firsts(idioms)), looked_up(phrase(*places)))
        paired = lambda *places: F.when(word(places[0]).isin(firsts(pairs)), phrase(*places).isin(pairs))

        def idiomatic(v: Column, i: Column) -> Column:
            # What the word begins comes before what it ends, and both before what stands in front of it.
            begun = (value(i, i + 1, i + 2), value(i, i + 1))
            ended = (value(i - 1, i), value(i - 2, i - 1, i))
            before = (value(i - 2, i - 1), value(i - 3, i - 2, i - 1), value(i - 3, i - 2))
            drop = F.when(paired(i - 3, i - 2) | paired(i - 2, i - 1), BOOST).otherwise(0.0)
            return F.when(plain(v, i, 3), F.coalesce(*begun, *ended, *before, v) - drop).otherwise(v)

        v = F.transform(v, idiomatic)

    def settled(v: Column, i: Column) -> Column:
        least = (low(i - 1) == "least") & F.get("__bases", i - 1).isNull() & ~F.coalesce(low(i - 2).isin("at", "very"), F.lit(False))
        skipped = boost(i).isNotNull() | ((low(i) == "kind") & F.coalesce(low(i + 1) == "of", F.lit(False)))
        but, place = F.col("__but"), i + 1
        weight = F.when((but > 0) & (place < but), 0.5).when((but > 0) & (place > but), 1.5).otherwise(1.0)
        return F.when(v.isNull() | skipped, 0.0).otherwise(v * F.when(least, NEGATION).otherwise(1.0) * weight)

    return facts.withColumn("__valences", F.transform(v, settled)).drop("__words", "__low", "__bases", "__caps", "__mixed", "__but", "__boosts", "__negates")


def token_valences(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, **rules) -> DataFrame:
    """(id, pos, valence) of every token."""
    return _with_valences(df.select(id_col, text_col), lexicon, id_col, text_col, **rules).select(id_col, F.posexplode("__valences").alias("pos", "valence"))


def _with_scores(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, **rules) -> DataFrame:
    """`df` with the struct `__scores` of neg, neu, pos, compound and sentiment_label."""
    # Four plain sums: one that carries all four would make a new row for every word.
    folded = lambda step: F.aggregate("__valences", F.lit(0.0), step)
    sums = {
        "__total0": folded(lambda acc, v: acc + v),
        "__up0": folded(lambda acc, v: F.when(v > 0, acc + v + 1).otherwise(acc)),
        "__down0": folded(lambda acc, v: F.when(v < 0, acc + 1 - v).otherwise(acc)),
        "__flat": folded(lambda acc, v: F.when(v == 0, acc + 1).otherwise(acc)),
    }
    text = F.col(text_col)
    bangs = F.least(F.length(text) - F.length(F.replace(text, F.lit("!"))), F.lit(4)) * 0.292
    marks = F.length(text) - F.length(F.replace(text, F.lit("?")))
    emphasis = bangs + F.when(marks > 3, 0.96).when(marks > 1, marks * 0.18).otherwise(0.0)
    scored = _with_valences(df, lexicon, id_col, text_col, **rules).withColumns({**sums, "__extra": emphasis})
    total, up, down, extra = F.col("__total0"), F.col("__up0"), F.col("__down0"), F.col("__extra")
    total = F.when(total > 0, total + extra).when(total < 0, total - extra).otherwise(total)
    scored = scored.withColumns({
        "__total": total, "__up": F.when(up > down, up + extra).otherwise(up), "__down": F.when(down > up, down + extra).otherwise(down),
    })
    total, up, down, flat = F.col("__total"), F.col("__up"), F.col("__down"), F.col("__flat")
    part = lambda c, digits=3: F.round(F.coalesce(F.try_divide(c, up + down + flat), F.lit(0.0)), digits)
    compound = F.round(F.coalesce(clamp(total / F.sqrt(total * total + ALPHA)), F.lit(0.0)), 4)
    scores = F.struct(
        part(down).alias("neg"), F.when(text.isNull(), 1.0).otherwise(part(flat)).alias("neu"), part(up).alias("pos"),
        compound.alias("compound"), sentiment_label(compound).alias("sentiment_label"),
    )
    return scored.withColumn("__scores", scores).drop("__valences", *sums, "__extra", "__total", "__up", "__down")


def lexicon_scores(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, **rules) -> DataFrame:
    """(id, neg, neu, pos, compound, sentiment_label) per row.

    `lexicon` is a (token, valence) table, tokens lower-case; the greatest valence of a token counts. Up to
    `map_words` of them become a constant of the plan, so a row is scored where it is read; longer lexicons are
    joined to the tokens, and then `id_col` must be unique. Null text is neutral (0, 1, 0, 0).
    """
    return _with_scores(df.select(id_col, text_col), lexicon, id_col, text_col, **rules).select(id_col, "__scores.*")


def headline_table(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, **rules) -> DataFrame:
    """Scores plus the headline's own features."""
    own = [c.alias(n) for n, c in headline_features(F.col(text_col)).items()]
    scored = _with_scores(df.select(id_col, text_col), lexicon, id_col, text_col, **rules)
    return scored.select(id_col, "__scores.neg", "__scores.neu", "__scores.pos", "__scores.compound", *own)


def add_sentiment(
    df: DataFrame, id_col: str, text_col: str = "review_text", lexicon: DataFrame | None = None, method: str | None = LEXICON_METHOD,
    scorer: Callable[[Column], Column] | None = None, score_col: str = "sentiment_score", label_col: str = "sentiment_label", **rules,
) -> DataFrame:
    """Score and label columns; null text is neutral. No method and any unknown one mean the lexicon.

    `scorer` (for method "scorer") is a vectorised function of the text column giving a struct
    (label, score), as sentiment models do; a row it cannot score, or no scorer at all, falls back
    to the lexicon.
    """
    if text_col not in df.columns:
        raise ValueError(f"no column {text_col!r} to score; the columns are {', '.join(df.columns)}")
    scored = _with_scores(df, lexicon, id_col, text_col, **rules)
    out = scored.withColumns({"__score": F.col("__scores.compound"), "__label": F.col("__scores.sentiment_label")}).drop("__scores")
    if method == SCORER_METHOD and scorer is not None:
        raw = scorer(F.coalesce(F.col(text_col), F.lit("")))
        out = out.withColumn("__raw", raw)
        label, known = F.lower(F.col("__raw")["label"]), F.col("__raw")["score"].isNotNull()
        named = F.when(label.like("%pos%"), "positive").when(label.like("%neg%"), "negative").otherwise("neutral")
        score = F.when(known, signed_score(label, F.col("__raw")["score"].cast("double"))).otherwise(F.col("__score"))
        out = out.withColumns({"__score": score, "__label": F.when(known, named).otherwise(F.col("__label"))}).drop("__raw")
    return out.withColumns({score_col: F.coalesce("__score", F.lit(0.0)), label_col: F.coalesce("__label", F.lit("neutral"))}).drop("__score", "__label")
