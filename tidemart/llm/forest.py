"""N-gram Jaccard join by MinHash prefixes, after the LSH forest, and exact verification.

A text is the set of its five-word shingles (lower case, split at white space; a shorter text is one shingle
of all its words). Texts of equal shingle sets are one class of copies, named by its smallest key; classes
are joined, copies are not expanded into pairs.

Every class has `trees` sequences of MinHash values, and classes that share a prefix of a sequence meet. The length of
the prefix is the greatest at which a pair right at the threshold meets in at least one tree with the target
probability (`shared_prefix`); more similar pairs meet oftener. It is one length for all data, worked out beforehand: a
forest that shortens prefixes by what each has matched is not built. Classes below one prefix ("node") are compared in blocks of
`block` by small sketches, with a margin wide enough that a true link is not lost there (under one in 10^5 at the
threshold, besides the recall target), and only a spanning set of the likely links goes on. The groups these
links connect are verified exactly, again in blocks: counts of common shingles come from matrix
products over the shingles that two texts share. What comes out are exact link counts and a spanning set
of exact links; no pair of a large group is ever a row.

Nodes and groups of any size are cut into blocks and every two blocks meet in a task of their own, so nothing is
capped. Texts without words have no shingles and link to nothing, not even to each other. Null keys are
a key of their own (rows with null keys fold into one). Keys are integers; repeated keys share a row in `classes`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.links import components
from tidemart.llm.rows import free_name, quoted
from tidemart.session import materialize

SHINGLE = 5
THRESHOLD = (4, 5)  # links have a Jaccard similarity of at least 4/5, compared in integers
TREES, DEPTH = 20, 6
TARGET_RECALL = 0.9999
SKETCH = 64
#: A link at 0.8 shows less than this share of equal sketch numbers once in 10^5 times (binomial tail).
SKETCH_SHARE = 0.58
BLOCK = 512
COLUMNS = 4096


def shared_prefix(trees: int = TREES, depth: int = DEPTH, similarity: float = 0.8, target: float = TARGET_RECALL) -> int:
    """The longest prefix at which a pair of this similarity meets in some tree with the target probability."""
    for length in range(depth, 0, -1):
        if 1 - (1 - similarity**length) ** trees >= target:
            return length
    raise ValueError("no prefix reaches the target recall; grow more trees")


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles, equal in every process."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = max(len(words) - SHINGLE + 1, 1)
    mixed = np.full(n, min(len(words), SHINGLE), np.uint64)
    for step in range(min(SHINGLE, len(words))):
        mixed = (mixed ^ hashed[step : step + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


class Sketcher:
    """MinHash values of a shingle set: `trees` x `depth` functions a x + b, taken by their upper bits."""

    def __init__(self, seed: int = 9, trees: int = TREES, depth: int = DEPTH):
        draw = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.a = draw.integers(0, 1 << 63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, trees * depth, np.uint64)

    def values(self, hashed: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, len(hashed), COLUMNS):
            part = hashed[start : start + COLUMNS, None] * self.a
            part += self.b
            np.minimum(low, part.min(axis=0), out=low)
        return low >> np.uint64(20)

    def nodes(self, values: np.ndarray, prefix: int) -> np.ndarray:
        """One hashed trie node per tree: the tree's number and the first `prefix` values of its sequence."""
        node = np.arange(1, self.trees + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for level in values.reshape(self.trees, self.depth).T[:prefix]:
            node = (node ^ level) * np.uint64(0xBF58476D1CE4E5B9)
            node ^= node >> np.uint64(31)
        return node.view(np.int64)


def sketch_texts(docs: DataFrame, key: str, text: str, prefix: int) -> DataFrame:
    """One row per document with words: key, set_key, its trie nodes, and a sketch of one byte per function."""
    rows = docs.select(F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(text)).cast("string").alias("text"))

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketcher = Sketcher()
        for batch in batches:
            out = []
            for key_, text_ in zip(batch["key"].astype(object).where(batch["key"].notna(), None), batch["text"], strict=True):
                hashed = shingles(text_ or "")
                if len(hashed):
                    values = sketcher.values(hashed)
                    set_key = hashlib.blake2b(hashed.tobytes(), digest_size=16).digest()
                    out.append((key_, set_key, sketcher.nodes(values, prefix), values[:SKETCH].astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["key", "set_key", "nodes", "sketch"]).astype({"key": "Int64"})

    return rows.mapInPandas(sketched, "key long, set_key binary, nodes array<long>, sketch binary")


def in_groups(names: list[str], work: Callable[[pd.DataFrame], Iterator[pd.DataFrame]]) -> Callable:
    """A function for `mapInPandas` over rows sorted by `names`: `work` gets whole groups, several at a time, also across batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if batch.empty:
                continue
            last = (batch[names] != batch[names].iloc[-1]).any(axis=1).to_numpy()
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            same = bool(held) and bool((held[-1][names].iloc[-1] == batch[names].iloc[0]).all())
            if cut or (held and not same):
                yield from work(pd.concat([*held, batch.iloc[:cut]], ignore_index=True))
                held = []
            held.append(batch.iloc[cut:])
        if held:
            yield from work(pd.concat(held, ignore_index=True))

    return run


def group_slices(rows: pd.DataFrame, names: list[str]) -> Iterator[tuple[int, int]]:
    values = rows[names].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]).any(axis=1)]))
    yield from zip(starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True)


def block_pairs(rows: DataFrame, group: str, size: str, member: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks (first, second) that its block is in; a group up to `block` rows is one block."""
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    placed = rows.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), blocks - 1)))
    paired = placed.select("*", F.least("own", "met").alias("first"), F.greatest("own", "met").alias("second"))
    return paired.repartition(group, "first", "second").sortWithinPartitions(group, "first", "second", member).drop("met", size)


def spanning(members: np.ndarray, linked: np.ndarray, group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that keep connected what `linked` (a square matrix of booleans) connects, to the smallest member of each part.

    With `group`, members of equal group are connected already and only links between groups are returned.
    """
    n = len(members)
    part = np.full(n, -1)
    if group is None:
        group = np.arange(n)
    links: list[tuple[int, int]] = []
    for start in range(n):
        if part[start] >= 0:
            continue
        reached = group == group[start]
        front = reached
        while front.any():
            new = linked[front].any(axis=0) | np.isin(group, group[front])
            new = np.isin(group, group[new]) & ~reached
            reached, front = reached | new, new
        part[reached] = start
        heads = {int(group[place]): int(members[place]) for place in np.flatnonzero(reached)[::-1]}
        low = min(heads.values())
        links.extend((head, low) for head in heads.values() if head != low)
    return links


def parts_of(linked: np.ndarray) -> np.ndarray:
    """A number for each row of a square matrix of links: rows that are connected have equal numbers."""
    n = len(linked)
    part = np.full(n, -1)
    for start in range(n):
        if part[start] >= 0:
            continue
        reached = np.zeros(n, bool)
        reached[start] = True
        front = reached
        while front.any():
            new = linked[front].any(axis=0) & ~reached
            reached, front = reached | new, new
        part[reached] = start
    return part


def block_links(members: np.ndarray, own: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links of two blocks; each block's own are left to the task of that block alone."""
    if len(set(own.tolist())) == 1:
        return spanning(members, linked)
    within = parts_of(linked & (own[:, None] == own[None, :]))
    return spanning(members, linked, within)


def likely_links(nodes: DataFrame, block: int = BLOCK, share: float = SKETCH_SHARE) -> DataFrame:
    """(a, b): spanning links among the members of each node whose sketches agree often enough."""
    names = ["node", "first", "second"]

    def work(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        members = rows["key"].to_numpy()
        sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), SKETCH)
        own = rows["own"].to_numpy()
        spans = list(group_slices(rows, names))
        two = np.array([start for start, end in spans if end - start == 2], np.int64)
        alike = (sketches[two] == sketches[two + 1]).mean(axis=1) >= share if len(two) else np.zeros(0, bool)
        found = [np.stack([members[two + 1], members[two]], axis=1)[alike]] if len(two) else []
        for start, end in spans:
            if end - start > 2:
                some = sketches[start:end]
                equal = np.zeros((end - start, end - start), np.uint8)
                for column in some.T:
                    equal += column[:, None] == column[None, :]
                links = block_links(members[start:end], own[start:end], equal >= share * SKETCH)
                if links:
                    found.append(np.array(links, np.int64))
        yield pd.DataFrame(np.concatenate(found) if found else np.zeros((0, 2), np.int64), columns=["a", "b"])

    pairs = block_pairs(nodes, "node", "n", "key", block)
    return pairs.select(*names, "own", "key", "sketch").mapInPandas(in_groups(names, work), "a long, b long").distinct()


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of every two sets, from matrix products over the elements that two sets share."""
    n = len(sets)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(one) for one in sets])
    _, column, counts = np.unique(elements, return_inverse=True, return_counts=True)
    shared = counts > 1
    numbered = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], numbered[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n), np.float64)
    for start in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        cells = np.zeros((n, min(COLUMNS, int(shared.sum()) - start)), np.float32)
        cells[owner[low:high], column[low:high] - start] = 1
        total += cells @ cells.T
    return total.astype(np.int64)


def exact_links(groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, n): verified spanning links with n null, and for each member a row (a, a, n) with links counted in one pair of blocks.

    `groups` has component, n (its size), key and text.
    """
    names = ["component", "first", "second"]
    high, low = THRESHOLD

    def work(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        members, own = rows["key"].to_numpy(), rows["own"].to_numpy()
        out: list[tuple[int, int, int | None]] = []
        for start, end in group_slices(rows, names):
            sets = [shingles(text) for text in rows["text"].iloc[start:end]]
            sizes = np.array([len(one) for one in sets])
            common = common_counts(sets)
            linked = low * common >= high * (sizes[:, None] + sizes[None, :] - common)
            np.fill_diagonal(linked, False)
            mine = own[start:end]
            across = linked if len(set(mine.tolist())) == 1 else linked & (mine[:, None] != mine[None, :])
            counts = across.sum(axis=1)
            out.extend((int(key), int(key), int(n)) for key, n in zip(members[start:end], counts, strict=True) if n)
            out.extend((a, b, None) for a, b in block_links(members[start:end], mine, linked))
        yield pd.DataFrame(out, columns=["a", "b", "n"]).astype({"a": "int64", "b": "int64", "n": "Int64"})

    pairs = block_pairs(groups, "component", "n", "key", block)
    return pairs.select(*names, "own", "key", "text").mapInPandas(in_groups(names, work), "a long, b long, n long")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per distinct key: key, class_id (smallest key of all it is linked with), copy_id (smallest key of
    equal shingle sets), n_links (other shingle sets linked to its own) and n_copies (documents of its set)."""
    name = quoted(key)
    prefix = shared_prefix()
    sketched = materialize(sketch_texts(docs, key, text, prefix), "sketches")
    sets = materialize(
        sketched.groupBy("set_key").agg(
            F.min("key").alias("copy_id"), F.count(F.lit(1)).alias("n_copies"), F.first("nodes").alias("nodes"), F.first("sketch").alias("sketch")
        ),
        "sets",
    )
    named = sets.filter(F.col("copy_id").isNotNull())
    posts = named.select(F.col("copy_id").alias("key"), "sketch", F.explode("nodes").alias("node"))
    crowded = materialize(posts.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "nodes")
    likely = likely_links(posts.join(crowded, "node"), block)
    likely_groups = materialize(components(likely), "groups")
    sizes = materialize(likely_groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sized = likely_groups.join(sizes, "component").withColumnRenamed("node", "key")
    texts = docs.select(F.col(name).cast("long").alias("key"), F.col(quoted(text)).cast("string").alias("text"))
    verified = materialize(exact_links(sized.join(texts, "key"), block), "verified")
    linked = materialize(components(verified.filter("n is null").select("a", "b")), "linked")
    counts = verified.filter("n is not null").groupBy("a").agg(F.sum("n").alias("n_links"))
    known = linked.join(counts, F.col("node") == F.col("a"), "left").select("node", "component", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    resolved = (
        sets.select("set_key", "copy_id", "n_copies")
        .join(known, F.col("copy_id") == F.col("node"), "left")
        .select("set_key", "copy_id", F.coalesce("component", "copy_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    )
    resolved = materialize(resolved, "resolved")
    member = sketched.select("key", "set_key").distinct().join(resolved, "set_key")
    alone = docs.select(F.col(name).cast("long").alias("key")).distinct()
    return alone.alias("d").join(member.alias("m"), F.col("d.key").eqNullSafe(F.col("m.key")), "left").select(
        F.col("d.key").alias(key), F.coalesce("class_id", "d.key").alias("class_id"), F.coalesce("copy_id", "d.key").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def one_of_each_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: the one with the smallest key, null keys last.

    Where keys are null or repeated, rows are numbered in a written copy and classed by that number, so rows
    of one key with different texts are judged each by its own text, and of equal rows one stays. Rows
    whose texts have no words all stay.
    """
    name = F.col(quoted(key))
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(name).alias("keys")).first()
    own = [F.col(quoted(column)) for column in docs.columns]
    if size["rows"] == size["keys"]:
        named = classes(docs, key, text)
        gone = named.filter(name != F.col("class_id")).select(name)
        return docs.join(gone, key, "left_anti").select(*own)
    number = free_name(docs.columns, "_row")
    rows = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    named = classes(rows.select(number, F.col(quoted(text)).alias("text")), number, "text").select(number, "class_id")
    keyed = rows.select(number, name.alias("key")).join(named, number)
    best = keyed.groupBy("class_id").agg(F.min(F.struct(F.col("key").isNull().alias("last"), "key", number)).alias("best"))
    return rows.join(best.select(F.col("best")[number].alias(number)), number, "left_semi").select(*own)
