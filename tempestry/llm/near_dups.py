"""Documents with similar sets of word shingles, joined by a matrix of tokens and groups of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import FEW_ROWS, hashed_texts, known_apart, mixed, parts_of, saved, share, signed, values, window_hashes
from tempestry.llm.graph import components
from tempestry.llm.twice import KEYED, Filters, emitted, repeats, seen_twice, told

#: Fill of the filters: here a false repeat costs little, and one in 80 passes.
FILL = 1 / 3
#: Words of a shingle, and the similarity from which two sets are linked, in percent.
SHINGLE, PERCENT = 5, 75
#: Documents that a group holds on average when a larger set of similar ones is split.
GROUP = 64
#: The same for teams, sets that have a frequent token in common.
TEAM = 256
#: Queries that meet one group in one task, on average.
QUERIES = 256
#: Part of a set's size by which the prefixes that are compared first are longer than one shared token needs.
LONGER = 0.15
#: The same for the prefixes of rare tokens that make the matrix.
RARE_LONGER = 0.05
#: Most cells of the table of token counts, and cells of one of its blocks.
MOST_CELLS, BLOCK = 1 << 22, 1 << 12
#: Most rows, of five numbers each, of the table of sets that is broadcast.
MANY_ROWS = 500_000


def shingles(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """Sorted hashes of each text's distinct shingles; of a shorter text's words as one; empty without words."""
    for _, words, windows in hashed_texts(texts, SHINGLE, lower=True):
        if 0 < len(words) < SHINGLE:
            windows = window_hashes(words, len(words))
        found = np.sort(windows)
        yield found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def least_shared(size):
    """Fewest tokens of a set of ``size`` that another set must share to be linked to it."""
    return -(-PERCENT * size // 100)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) < least_shared(max(len(a), len(b))):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _more(size: int, longer: float) -> int:
    return max(1, int(longer * size))


def prefix_length(size: int, longer: float = LONGER) -> int:
    """First tokens of a set, in any order of all tokens, that are compared.

    Of the tokens that two linked sets share, the first ``_more(size)`` are
    among these in both sets (with ``size`` that of the smaller set).
    """
    return size - least_shared(size) + _more(size, longer)


def prefix_shared(size: int, longer: float = LONGER) -> int:
    """Fewest tokens of a set's prefix that are in the prefix of another, if they are linked."""
    return _more(least_shared(size), longer)


def _set_keys(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    digest = xxhash.xxh3_128_digest(tokens.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, tuple[int, int], np.ndarray, bool]]]:
    """Per batch: doc_id, keys, tokens of each row, and whether the set is new in this partition."""
    seen: set[tuple[int, int]] = set()
    for batch in parts_of(batches):
        out = []
        for doc, tokens in zip(values(batch.column("doc_id")), shingles(values(batch.column("text")))):
            keys = _set_keys(tokens)
            out.append((doc, keys, tokens, bool(len(tokens)) and keys not in seen))
            seen.add(keys)
        yield out


def _prefix_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _sets(batches):
        prefixes = [tokens[: prefix_length(len(tokens))] for _, _, tokens, new in rows if new]
        yield emitted(np.concatenate([np.empty(0, np.uint64), *prefixes]))


_ROW = "doc_id long, key long, check long, n_shingles long, bucket long, tokens binary, listed boolean"


def _bucket(tokens: np.ndarray) -> int:
    """The smallest token by a second order."""
    return int(mixed(tokens).min().view(np.int64))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _suspects(filters: Filters):
    """Rows of all documents, with tokens where enough of the prefix may be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _sets(batches):
            prefixes = [tokens[: prefix_length(len(tokens))] if new else tokens[:0] for _, _, tokens, new in rows]
            hit = filters.may_repeat(np.concatenate([np.empty(0, np.uint64), *prefixes]))
            ends = np.cumsum([len(p) for p in prefixes])
            total = np.concatenate([[0], np.cumsum(hit)])
            out = []
            for k, (doc, keys, tokens, new) in enumerate(rows):
                shared = total[ends[k]] - total[ends[k] - len(prefixes[k])]
                suspect = new and shared >= prefix_shared(len(tokens))
                out.append((doc, *keys, len(tokens), _bucket(tokens) if suspect else None, tokens.tobytes() if suspect else None, True))
            yield _batch(out, _ROW)

    return run


_SIZES = "doc_id long, key long, check long, n_shingles long, text_key long, text_check long"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents, with the keys of their texts."""
    for batch in parts_of(batches):
        out = []
        known = zip(*(values(batch.column(c)) for c in ("doc_id", "text_key", "text_check")))
        for (doc, *keys), tokens in zip(known, shingles(values(batch.column("text")))):
            out.append((doc, *_set_keys(tokens), len(tokens), *keys))
        yield _batch(out, _SIZES)


def _keyed_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of texts to rows of each token of their sets' prefixes (``twice.KEYED``)."""
    for rows in _sets(batches):
        found = [(keys[0], tokens[: prefix_length(len(tokens))]) for _, keys, tokens, new in rows if new]
        keys = np.repeat(np.array([k for k, _ in found], np.int64), [len(t) for _, t in found])
        yield told(np.concatenate([np.empty(0, np.uint64), *(t for _, t in found)]), keys)


def _tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of the texts of suspects to their tokens."""
    for batch in parts_of(batches):
        out = []
        for tokens in shingles(values(batch.column("text"))):
            out.append((None, *_set_keys(tokens), len(tokens), _bucket(tokens), tokens.tobytes(), False))
        yield _batch(out, _ROW)


def _suspects_by_join(slim: DataFrame) -> DataFrame:
    """As ``_suspects``, where the filters are too large to be broadcast: prefixes meet the filters, and what they
    find is joined to the texts. The texts are read three times and shuffled once, whatever their number."""
    known = slim.withColumns({"text_key": F.xxhash64("text"), "text_check": F.xxhash64(F.lit(1), "text")})
    sizes = saved(known.mapInArrow(_sizes, _SIZES), "set-sizes")
    shared = repeats(slim.mapInArrow(_keyed_prefixes, KEYED), "prefix-tokens")
    shared = shared.groupBy("key").agg(F.size(F.collect_set("hash")).alias("shared"))
    least = F.ceil(F.col("n_shingles") * PERCENT / 100)
    enough = F.col("shared") >= F.greatest(F.lit(1), F.floor(least * F.lit(LONGER)))
    sets = sizes.where("n_shingles > 0").groupBy("key", "check", "n_shingles").agg(F.min(F.struct("text_key", "text_check")).alias("t"))
    texts = saved(sets.join(shared, "key").where(enough).select("t.*").distinct(), "suspected-texts")
    tokens = known.join(texts, ["text_key", "text_check"], "left_semi").dropDuplicates(["text_key", "text_check"])
    listed = sizes.select(
        "doc_id", "key", "check", "n_shingles", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("tokens"),
        F.lit(True).alias("listed"),
    )
    return listed.unionByName(saved(tokens.select("text").mapInArrow(_tokenized, _ROW), "shingles"))


def _token_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts_of(batches):
        yield emitted(np.concatenate([np.empty(0, np.uint64), *map(_tokens, batch.column("tokens").to_pylist())]))


def _keyed_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts_of(batches):
        sets = [_tokens(value) for value in batch.column("tokens").to_pylist()]
        keys = np.repeat(batch.column("key").to_numpy(), [len(s) for s in sets])
        yield told(np.concatenate([np.empty(0, np.uint64), *sets]), keys)


def _repeated(filters: Filters):
    """The sets of which as many tokens as a link needs may be in another set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            sets = [_tokens(value) for value in batch.column("tokens").to_pylist()]
            hit = filters.may_repeat(np.concatenate([np.empty(0, np.uint64), *sets]))
            ends = np.cumsum([len(s) for s in sets])
            total = np.concatenate([[0], np.cumsum(hit)])
            enough = [total[end] - total[end - len(s)] >= least_shared(len(s)) for s, end in zip(sets, ends)]
            yield batch.filter(pa.array(enough, pa.bool_()))

    return run


def _sets_with_partners(suspects: DataFrame, number: int) -> DataFrame:
    """Those of the sets that have as many tokens in other sets as a link needs; one row of each."""
    filters = seen_twice(suspects.mapInArrow(_token_hashes, "hash long"), number, "token-filters", FILL)
    if filters is None:
        shared = repeats(suspects.mapInArrow(_keyed_tokens, KEYED), "set-tokens")
        shared = shared.groupBy("key").agg(F.size(F.collect_set("hash")).alias("shared"))
        found = suspects.join(shared, "key").where(F.col("shared") >= F.ceil(F.col("size") * PERCENT / 100)).drop("shared")
        return saved(found.dropDuplicates(["key"]), "sets")
    found = saved(suspects.mapInArrow(_repeated(filters), suspects.schema), "repeated-sets")
    filters.release()
    return saved(found.dropDuplicates(["key"]), "sets")


def _tokens(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def _roots(rows: pd.DataFrame) -> pd.DataFrame:
    """Link the sets of one chunk to clusters; each set gets the key of its cluster's root.

    Sets are taken by size, so that a set meets those of its size first. Two
    sets of one cluster are not compared again.
    """
    keys = rows["key"].to_numpy()
    order = np.lexsort((keys, [len(t) for t in rows["tokens"]]))
    tokens = [_tokens(bytes(rows["tokens"].iloc[i])) for i in order]
    parent = list(range(len(order)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(order)):
        for j in range(i):
            a, b = find(i), find(j)
            if a != b and linked(tokens[i], tokens[j]):
                parent[max(a, b)] = min(a, b)
    roots = [keys[order][find(i)] for i in range(len(order))]
    return pd.DataFrame({"bucket": rows["bucket"].to_numpy(), "key": keys[order], "root": roots})


def _groups(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of similar sets, and the components that roots of groups form.

    Sets with one smallest token (by a second order) are similar in most
    cases. They are dealt out to chunks of about GROUP, and each chunk's
    clusters are groups: bounded in size, and connected by links that were
    verified. The roots of a bucket that was split are then chunked and linked in
    turn, level by level, as often as the largest bucket needs to come down to
    one chunk. Returns ``key, root`` and ``root, label``.
    """
    nodes, out = sets.select("key", "bucket", "tokens"), []
    counts = saved(sets.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1"), "buckets")
    most = counts.agg(F.max("held")).first()[0] or 1
    for level in range(max(1, ceil(log(most) / log(GROUP)))):
        chunk = F.pmod(F.xxhash64("key", F.lit(level)), F.ceil(F.col("held") / GROUP))
        chunked = nodes.join(share(counts, FEW_ROWS), "bucket").select("bucket", chunk.alias("chunk"), "key", "tokens")
        roots = chunked.groupBy("bucket", "chunk").applyInPandas(_roots, "bucket long, key long, root long")
        roots = saved(roots, "groups")
        out.append(roots)
        again = roots.where("key = root").join(share(counts.where(F.col("held") > GROUP).select("bucket"), FEW_ROWS), "bucket")
        nodes = sets.select("key", "tokens").join(share(again.select("key", "bucket"), FEW_ROWS), "key")
        counts = again.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    labels = out[0].select("root").distinct().withColumn("label", F.col("root"))
    for roots in out[1:]:
        higher = roots.select(F.col("key").alias("label"), F.col("root").alias("higher"))
        labels = labels.join(higher, "label", "left").select("root", F.coalesce("higher", "label").alias("label"))
    return out[0].select("key", "root"), labels


def _counted(cells: int):
    """Batches of token sets to blocks of a table of how often its cells' tokens occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch in batches:
            for value in batch.column("tokens").to_pylist():
                np.add.at(counts, _cell(_tokens(value), cells), 1)
        for k, block in enumerate(counts.reshape(-1, min(BLOCK, cells))):
            if block.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([zlib.compress(block.tobytes(), 1)], pa.binary())], ["block", "counts"]
                )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            block = np.frombuffer(zlib.decompress(counts), np.uint32)
            total[k] = total[k] + block if k in total else block
    for k, block in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int64()), pa.array([block.tobytes()], pa.binary())], ["block", "counts"]
        )


def _cell(tokens: np.ndarray, cells: int) -> np.ndarray:
    return mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(cells - 1)


def _token_counts(sets: DataFrame, number: int) -> np.ndarray:
    """About how often tokens occur, by cells that tokens share; at most MOST_CELLS of 4 bytes."""
    cells = min(MOST_CELLS, max(1 << 12, 1 << (number // 4).bit_length()))
    schema = "block long, counts binary"
    parts = sets.select("tokens").mapInArrow(_counted(cells), schema)
    blocks = saved(parts.repartition("block").mapInArrow(_added, schema), "token-counts")
    out = np.zeros(cells, np.uint32).reshape(-1, min(BLOCK, cells))
    for row in blocks.collect():
        out[row.block] = np.frombuffer(bytes(row.counts), np.uint32)
    return out.ravel()


def _rare_tokens(counts):
    """Batches of (key, tokens) to a row for each token of the set's prefix in the order of rareness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            tokens, rows = [], []
            for k, value in enumerate(batch.column("tokens").to_pylist()):
                found = _tokens(value)
                order = np.lexsort((found, table[_cell(found, len(table))]))
                prefix = found[order[: prefix_length(len(found), RARE_LONGER)]]
                tokens.append(prefix)
                rows.append(np.full(len(prefix), k))
            take = pa.array(np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([np.empty(0, np.uint64), *tokens]))),
                    batch.column("key").take(take),
                ],
                ["token", "key"],
            )

    return run


def _top_token(counts):
    """Batches of (key, tokens) to the token of each set that is most frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            top = []
            for value in batch.column("tokens").to_pylist():
                tokens = _tokens(value)
                top.append(int(tokens[np.argmax(counts.value[_cell(tokens, len(counts.value))])].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(top, pa.int64())], ["key", "top"])

    return run


def _alike(sets: DataFrame, counts) -> DataFrame:
    """``key, team``: all sets in teams of about TEAM that have their most frequent token in common."""
    tops = sets.select("key", "tokens").mapInArrow(_top_token(counts), "key long, top long")
    tops = saved(tops, "top-tokens")
    held = tops.groupBy("top").agg(F.ceil(F.count("*") / TEAM).alias("chunks"))
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks"))
    return saved(tops.join(share(held, FEW_ROWS), "top").select("key", F.xxhash64("top", chunk).alias("team")), "teams")


def _opened(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """Links from queries to a group's members of other labels, as pairs of labels.

    The union of the group's tokens bounds the overlap, and only a query that
    it can hold is compared with the members, with each label until one is linked.
    """
    sets = [_tokens(bytes(t)) for t in members["tokens"]]
    if not sets:
        return pd.DataFrame([], columns=["a", "b"], dtype="int64")
    ranks = list(zip(members["held"], members["label"]))
    union = np.unique(np.concatenate(sets))
    out = set()
    for held, label, value in zip(queries["query_held"], queries["query_label"], queries["query"]):
        query = _tokens(bytes(value))
        place = np.minimum(np.searchsorted(union, query), len(union) - 1)
        if (union[place] == query).sum() < least_shared(len(query)):
            continue
        for rank, member in zip(ranks, sets):
            if (held, label) < rank and label != rank[1] and (label, rank[1]) not in out and linked(query, member):
                out.add((label, rank[1]))
    return pd.DataFrame(list(out), columns=["a", "b"], dtype="int64")


def _open(sets: DataFrame, pairs: DataFrame, group: str) -> DataFrame:
    """Links (``a, b``) of the pairs of a query (``key, held, label``) and a group of sets.

    A query is compared with members of components of more sets, or as many and a larger label.
    The members meet the queries in parts of about QUERIES.
    """
    parts = pairs.groupBy(group).agg(F.ceil(F.count("*") / QUERIES).alias("parts"))
    asked = (
        pairs.join(parts, group)
        .withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
        .join(sets.select("key", "tokens"), "key")
        .select(
            F.col(group).alias("asked"),
            F.col("part").alias("asked_part"),
            F.col("held").alias("query_held"),
            F.col("label").alias("query_label"),
            F.col("tokens").alias("query"),
        )
    )
    numbers = F.sequence(F.lit(0), F.col("parts").cast("long") - 1)
    members = sets.join(parts, group).select(group, F.explode(numbers).alias("part"), "held", "label", "tokens")
    found = asked.groupBy("asked", "asked_part").cogroup(members.groupBy(group, "part"))
    return found.applyInPandas(_opened, "a long, b long").distinct()


def _several(cells: DataFrame) -> DataFrame:
    """The cells of tokens that sets of two labels or more have."""
    labels = cells.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return cells.join(labels.where("low < high").select("token"), "token", "left_semi")


def _enough() -> Column:
    """Whether a query shares as many rare tokens with a group as a link to one of its members needs."""
    needed = F.ceil(F.col("size") * PERCENT / 100)
    return F.col("shared") >= F.greatest(F.lit(1), F.floor(needed * F.lit(RARE_LONGER)))


def _labelled(known: DataFrame) -> DataFrame:
    """``known`` with ``held``, the number of sets of its label."""
    held = known.groupBy("label").agg(F.count("*").alias("held"))
    return share(saved(known.join(held, "label"), "set-labels"), MANY_ROWS)


def _cross_links(sets: DataFrame, known: DataFrame, number: int) -> DataFrame:
    """Links between components: pairs of labels.

    ``sets`` has ``key, tokens``, ``known`` has ``key, root, label, size``. The
    token-group matrix has the rare tokens of each group's members, prefixes of
    which linked sets share some. A set queries the groups with members of
    other components with which it shares enough of them.

    First only one group for each token is queried, that of the smallest label,
    and of each two components only the pair that shares most tokens is opened.
    This takes a row per cell, and joins what is similar throughout. Then every
    set queries all groups, which now are teams of sets that share a frequent
    token: so sets that have a passage in common, but are not linked, are a few groups too.
    """
    counts = sets.sparkSession.sparkContext.broadcast(_token_counts(sets, number))
    matrix = sets.select("key", "tokens").mapInArrow(_rare_tokens(counts), "token long, key long")
    matrix = saved(matrix, "rare-tokens")
    known = _labelled(known)
    cells = saved(_several(matrix.join(known, "key")), "matrix")
    center = cells.groupBy("token").agg(F.min(F.struct("held", "label", "root")).alias("center"))
    star = (
        cells.join(center, "token")
        .where(F.col("label") != F.col("center.label"))
        .groupBy("key", "label", "held", "size", F.col("center.root").alias("root"), F.col("center.label").alias("other"))
        .agg(F.count("*").alias("shared"))
        .where(_enough())
    )
    best = F.max_by(F.struct("key", "root", "held"), F.struct("shared", "key", "root")).alias("best")
    star = star.groupBy("label", "other").agg(best).select("best.key", "label", F.lit(-1).alias("held"), "best.root")
    links = saved(_open(sets.join(known.select("key", "root", "label", "held"), "key"), saved(star, "star"), "root"), "star-links")
    joined = components(links).select(F.col("node").alias("label"), F.col("label").alias("joined"))
    known = known.drop("held").join(joined, "label", "left").withColumn("label", F.coalesce("joined", "label")).drop("joined")
    known = _labelled(known.join(_alike(sets, counts), "key"))
    cells = saved(_several(cells.select("token", "key").join(known, "key")), "matrix-apart")
    groups = cells.groupBy("token", "team").agg(
        F.max(F.struct("held", "label")).alias("largest_label"),
        F.min("size").alias("smallest"),
        F.max("size").alias("largest"),
    )
    possible = (F.col("size") * 100 >= F.col("smallest") * PERCENT) & (F.col("largest") * 100 >= F.col("size") * PERCENT)
    pairs = (
        cells.select("token", "key", "label", "held", "size")
        .join(groups, "token")
        .where((F.struct("held", "label") < F.col("largest_label")) & possible)
        .groupBy("key", "label", "held", "size", "team")
        .agg(F.count("*").alias("shared"))
        .where(_enough())
    )
    members = sets.join(known.select("key", "team", "label", "held"), "key")
    return links.unionByName(saved(_open(members, saved(pairs, "pairs"), "team"), "cross-links"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document, the smallest id that links lead to.

    A text, A-Z in lower case, is the set of its distinct shingles of SHINGLE
    words, or of all its words if there are fewer. Two texts are linked if
    they share at least PERCENT percent of all their shingles.

    1. Equal sets are one from here on. Filters of the prefixes' tokens, which go to the texts or, if they are too
       large for that, are met by the tokens, find the
       sets of which enough may be shared with another, and filters of all
       their tokens those of which as many as a link needs are in others. Only these go on, as sorted hashes.
    2. Similar sets form groups of bounded size, whose links are verified (``_groups``).
    3. The matrix of tokens and groups finds which sets of other components a group may
       hold links to; overlap with the group's token union decides which groups are opened (``_cross_links``).
    4. Components of all links.

    All these bounds are necessary conditions, so no link between components
    is lost. Links inside a component are not listed, nor are pairs of copies.
    Shingles are known by 64-bit hashes of their words, equal sets by 128 bits and their size.

    Null and blank texts have no shingles and are linked with nothing, each a
    component of its own id. Rows repeated are equal sets. A null id is no component's id unless there is no other.
    An empty table gives no rows, and further columns are ignored.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    words = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    filters = seen_twice(slim.mapInArrow(_prefix_hashes, "hash long"), words // 12, "prefix-filters", FILL)
    if filters is None:
        rows = _suspects_by_join(slim)
    else:
        rows = saved(slim.mapInArrow(_suspects(filters), _ROW), "shingles")
        filters.release()
    rows, _ = known_apart(rows, "key", ["check", "n_shingles"], "equal-sets")
    suspects = rows.where("tokens IS NOT NULL").select("key", F.col("n_shingles").alias("size"), "bucket", "tokens")
    number = suspects.agg(F.sum("size")).first()[0] or 0
    sets = _sets_with_partners(suspects, number)
    roots, labels = _groups(sets)
    known = (
        sets.select("key", "size")
        .join(roots, "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
        .join(labels, "root", "left")
        .withColumn("label", F.coalesce("label", "root"))
    )
    known = saved(known, "set-labels")
    known = known.select("key", "root", "label", "size")
    joined = components(_cross_links(sets.select("key", "tokens"), known, number))
    joined = joined.select(F.col("node").alias("label"), F.col("label").alias("joined"))
    label = known.join(joined, "label", "left").select("key", F.coalesce("joined", "label").alias("label"))
    listed = rows.where("listed").select("doc_id", "key", "n_shingles")
    smallest = listed.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    smallest = smallest.join(label, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = smallest.groupBy("label").agg(F.min("first").alias("component_id"))
    component = smallest.join(least, "label").select("key", "component_id")
    return listed.join(component, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with only the documents whose id is that of their component.

    Rows with one id and text stay once. Rows without an id cannot stand for a
    component and all stay, equal texts once.
    """
    found = similar_documents(docs, id_col, text_col)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("check"),
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
    )
    stay = rows.join(kept, "doc_id", "left_semi").unionByName(rows.where("doc_id IS NULL"))
    return stay.groupBy("doc_id", "check").agg(F.first("row").alias("row")).select("row.*")
