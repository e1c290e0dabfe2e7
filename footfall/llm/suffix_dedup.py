"""Repeated passages by suffix sorting with linear grouping.

Every string of a search's length that starts in two places is found, and each
byte that such a string covers is removed.  A search reads texts as symbols:
bytes (strings of ``LENGTH``), or the 64-bit hashes of their words in a row, so
that passages of ``PASSAGE`` words repeat whatever stands between the words.
All searches share one pass: their keys are kept apart, the steps are the same.
Suffixes are sorted where equal strings are bound to meet:

1. Runs.  A string's key is the least hash of its short substrings, so equal
   strings have equal keys; starts with one key at one place are a run, whose
   region is the text under them.  The key's place differs among the strings
   of a run, so no two of them are equal.  Per run only hashes travel.
2. Keys.  Nearly all keys occur once.  Keys alone are counted, with partial
   aggregation, and only the runs of keys that occur twice go on (a bitmap
   holds most others back before the join that decides).
3. Classes.  Runs with one key and equal regions are a class.  All starts of a
   class with two runs repeat, whatever its size.
4. Shards.  Only keys with different regions are left.  One region a class
   goes to the key's shard.  There the regions are cut at content-defined
   anchors into chunks, and the suffixes of the chunk sequence are sorted by
   linear grouping: groups of suffixes by their Lyndon prefix, in descending
   order, each splitting the groups of its previous-smaller pointers; then the
   order inside each group is emitted along those pointers.  No renaming
   recursion.  Neighbours in the order that share enough bytes are candidates;
   their starts repeat where two of them carry the same string.
5. A key whose regions are more than a shard's bytes is not sorted in one
   task: the hashes of its strings go to the shards of the hashes, and are
   compared there.
6. The spans of a document are merged and cut.  Texts without spans are not
   shuffled for it.

Equality is that of 128-bit hashes (key and region hash, or two string
hashes).  Before texts are shuffled, a bitmap keeps back most of those that
own no region to be sorted, or no span.

Defined results: a null text is an empty text; rows that repeat are copies of
each other and lose their repeats; texts shorter than the length keep
everything; a null doc_id is an id like any other; extra columns are ignored
or kept as they are; an empty table gives no rows; very long texts take memory
in proportion to one text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import id_text, keyed, membership, probable_owners, release_memory, row_hash, stored, table

LENGTH = 400                  # bytes
PASSAGE = 51                  # words: passages of over 50 that repeat
SHARD_BYTES = 2_000_000
ROWS_SENT = 4_096
KEPT_POWERS = 1 << 18         # powers of a base that one worker keeps, 2 MB
GROUP_SYMBOLS = 1 << 14       # symbols of short texts that are searched for runs together
_WORD = re.compile(rb"\S+")

_U64 = np.uint64


def byte_symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def word_symbols(text: str) -> np.ndarray:
    """The hashes of a text's words."""
    words = text.encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U64, len(words))


@dataclass(frozen=True)
class Search:
    """Strings of ``length`` symbols of what ``encode`` makes of a text; a key
    is a hash of ``gram`` symbols, an anchor of ``anchor`` symbols stands at
    every ``every``-th place or so."""
    length: int
    encode: Callable[[str], np.ndarray] = byte_symbols
    dtype: type = np.uint8
    gram: int = 32
    anchor: int = 8
    every: int = 32

    @property
    def shared(self) -> int:
        """Symbols that sorted neighbours must share to be candidates."""
        return self.length // 2

    @property
    def width(self) -> int:
        return np.dtype(self.dtype).itemsize


def byte_search(length: int = LENGTH) -> Search:
    return Search(length)


def word_search(words: int = PASSAGE) -> Search:
    return Search(words, word_symbols, np.uint64, min(4, words), 1, 8)


def _finish(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U64(32))) * _U64(0x94D049BB133111EB)
        return h ^ (h >> _U64(29))


def gram_hashes(data: np.ndarray, width: int, factor: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of every substring of ``width`` symbols; the hash of a substring
    comes from those of its parts, whose widths are powers of two."""
    if len(data) < width:
        return np.empty(0, _U64)
    with np.errstate(over="ignore"):
        h = (data.astype(_U64) + _U64(1)) * _U64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> _U64(31))) * _U64(0xBF58476D1CE4E5B9)
        out, done, f, w = None, 0, _U64(factor), 1
        while True:
            if width & w:
                if out is None:
                    out = h
                else:                               # out covers `done` symbols, h the next w
                    n = len(data) - done - w + 1
                    out = out[:n] * f + h[done:done + n]
                done += w
            if w * 2 > width:
                return _finish(out[:len(data) - width + 1])
            h = h[:-w] * f + h[w:] if w < len(h) else h[:0]
            f, w = f * f, w * 2


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row, from minima within blocks."""
    n = len(h)
    blocks = np.full(-(-n // width) * width, np.iinfo(_U64).max, _U64)
    blocks[:n] = h
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n - width + 1], behind[width - 1:n])


def runs_of(data: np.ndarray, search: Search, size: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first start, start after the last) of each run; with ``size``, of
    texts of so many symbols each that stand one after another in ``data``."""
    if len(data) < search.length:
        none = np.empty(0, np.int64)
        return none.astype(_U64), none, none
    grams = gram_hashes(data, search.gram)
    key = _least(grams, search.length - search.gram + 1)
    size = np.array([len(data)]) if size is None else size
    begin, starts = np.cumsum(size) - size, size - search.length + 1        # of each text
    begin, starts = begin[starts > 0], starts[starts > 0]
    step = np.zeros(len(key) + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + starts, -1)
    is_start = np.cumsum(step) > 0
    # a run ends where its key changes, where its first substring with the key's hash is left behind, or with its text
    new = is_start.copy()
    new[1:-1] &= (key[1:] != key[:-1]) | (grams[:len(key) - 1] == key[:-1])
    new[begin] = new[begin + starts] = True
    edge = np.flatnonzero(new)
    run = np.flatnonzero(is_start[edge])
    first = edge[run]
    return key[first], first, edge[run + 1]


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


_kept_powers: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), by doubling; a worker keeps up to
    KEPT_POWERS of them for its next texts."""
    kept = _kept_powers.get(base)
    if kept is not None and n <= len(kept):
        return kept[:n]
    size = max(1, n) if n > KEPT_POWERS else max(4_096, 1 << (n - 1).bit_length())
    out, done = np.ones(size, _U64), 1
    with np.errstate(over="ignore"):
        while done < size:
            step = _U64(pow(base, done, 1 << 64))
            out[done:2 * done] = out[:min(done, size - done)] * step
            done *= 2
    if size <= KEPT_POWERS:
        out.flags.writeable = False
        _kept_powers[base] = out
    return out[:n]


def region_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[begin:end] for each region: a polynomial in the scattered
    symbols, from prefix sums."""
    if not len(begin):
        return np.empty(0, _U64)
    with np.errstate(over="ignore"):
        terms = np.zeros(len(data) + 1, _U64)
        terms[1:] = _finish((data.astype(_U64) + _U64(1)) * _U64(0x9E3779B97F4A7C15)) * _powers(_BASE, len(data))
        total = np.cumsum(terms, dtype=_U64)
        return _finish((total[end] - total[begin]) * _powers(_INVERSE, int(begin.max()) + 1)[begin]
                       + (end - begin).astype(_U64))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of whole numbers; the last must be the least and
    occur once.

    Groups are intervals of ``order``, held by their first place.  The groups
    are taken from the last to the first; when one is taken, it holds the
    suffixes with one Lyndon prefix.  For each member the previous smaller
    suffix, the nearest on its left in a lower group, is known by following
    pointers; those that got more members move behind the rest of their
    groups.  Then the suffixes are emitted: the next one placed puts the one
    before it, and all along its pointers, at the front of their groups."""
    n = len(symbols)
    if n == 0:
        return np.empty(0, np.int64)
    values = np.asarray(symbols)
    sorted_ = np.argsort(values, kind="stable")
    new = np.concatenate([[True], np.diff(values[sorted_]) != 0])
    begin = np.flatnonzero(new)
    start_of = np.empty(n, np.int64)
    start_of[sorted_] = begin[np.cumsum(new) - 1]
    order, group = sorted_.tolist(), start_of.tolist()
    where = np.empty(n, np.int64)
    where[sorted_] = np.arange(n)
    where = where.tolist()
    size = [0] * n
    for b, k in zip(begin.tolist(), np.diff(np.append(begin, n)).tolist(), strict=True):
        size[b] = k
    smaller = [-1] * n                       # previous smaller suffix
    skip = [-1] * n                          # like it, shortened while it is followed
    end = n
    while end > 0:
        first = group[order[end - 1]]
        members = order[first:end]
        if len(members) > 1:
            members.sort()
        votes: dict[int, int] = {}
        for i in members:
            p = i - 1
            if p >= 0 and group[p] >= first:
                q = skip[p]
                while q >= 0 and group[q] >= first:
                    q = skip[q]
                while p >= 0 and group[p] >= first:      # shorten what was followed
                    p, skip[p] = skip[p], q
                p = q
            smaller[i] = skip[i] = p
            if p >= 0:
                votes[p] = votes.get(p, 0) + 1
        if votes:
            if len(members) == 1 or len(votes) == len(members):
                ranked = [(1, list(votes))]
            else:
                by_votes: dict[int, list[int]] = {}
                for p, v in votes.items():
                    by_votes.setdefault(v, []).append(p)
                ranked = sorted(by_votes.items(), reverse=True)
            for _, chosen in ranked:
                moved: dict[int, list[int]] = {}
                for p in chosen:
                    moved.setdefault(group[p], []).append(p)
                for g, ps in moved.items():
                    last = g + size[g]
                    if len(ps) == size[g]:
                        continue                         # the whole group: it stays
                    for p in ps:
                        last -= 1
                        a, other = where[p], order[last]
                        order[a], where[other] = other, a
                        order[last], where[p] = p, last
                    size[last] = len(ps)
                    size[g] -= len(ps)
                    for p in ps:
                        group[p] = last
        end = first
    out = [-1] * n
    placed = [False] * n
    front = list(range(n))                   # next free place of the group that starts there
    out[0] = order[0]
    placed[order[0]] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            placed[j] = True
            j = smaller[j]
    return np.array(out, np.int64)


def _candidates(data: np.ndarray, begin: np.ndarray, end: np.ndarray, search: Search) -> np.ndarray:
    """Mask over the symbols of all regions: starts that may repeat, by sorting
    the suffixes of the regions' chunk sequences."""
    length, gram = search.length, search.anchor
    mask = np.zeros(len(data), bool)
    starts = np.zeros(len(data) + 1, np.int64)           # places where a string starts, by difference
    np.add.at(starts, begin, 1)
    np.add.at(starts, end - length + 1, -1)
    is_start = np.cumsum(starts[:-1]) > 0
    h = gram_hashes(data, gram)
    region = np.repeat(np.arange(len(begin)), end - begin)
    anchor = np.flatnonzero((h & _U64(search.every - 1)) == 0)
    anchor = anchor[anchor + gram <= end[region[anchor]]]
    if not len(anchor):
        return is_start
    owner = region[anchor]
    last_of_region = np.append(owner[1:] != owner[:-1], True)
    follow = np.append(anchor[1:], len(data))
    span = np.where(last_of_region, 0, follow - anchor)
    # a chunk runs from its anchor through the next one's symbols; its name is its place among all chunks
    whole = np.flatnonzero(~last_of_region)
    view, w = memoryview(data.tobytes()), search.width
    names = np.fromiter((xxhash.xxh3_64_intdigest(view[a * w:(b + gram) * w])
                         for a, b in zip(anchor[whole].tolist(), follow[whole].tolist(), strict=True)), _U64, len(whole))
    distinct, name = np.unique(names, return_inverse=True)
    symbols = np.empty(len(anchor) + 1, np.int64)
    symbols[np.flatnonzero(last_of_region)] = np.arange(1, last_of_region.sum() + 1)     # each ends its region
    symbols[whole] = name + last_of_region.sum() + 1
    symbols[-1] = 0
    order = suffix_array(symbols)[1:]
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(left), np.int64)
    span = np.append(span, 0)
    live = np.arange(len(left))
    while len(live):
        a, b = left[live], right[live]
        same = (symbols[a] == symbols[b]) & (shared[live] < search.shared)
        live = live[same]
        shared[live] += span[left[live]]
        left[live] += 1
        right[live] += 1
    close = shared + gram >= search.shared
    chosen = np.zeros(len(anchor), bool)
    chosen[order[:-1][close]] = True
    chosen[order[1:][close]] = True
    # a start looks at its first anchor; without enough anchored symbols it is a candidate anyway
    place = np.flatnonzero(is_start)
    first = np.searchsorted(anchor, place)
    last = np.searchsorted(anchor, place + length - gram, "right") - 1
    few = (first > last) | (anchor[np.minimum(last, len(anchor) - 1)] - anchor[np.minimum(first, len(anchor) - 1)]
                            + gram < search.shared)
    mask[place[few | chosen[np.minimum(first, len(anchor) - 1)]]] = True
    return mask


def repeated_starts(regions: list[bytes], copies: list[int], search: Search) -> list[np.ndarray]:
    """For each region (its symbols' bytes) the starts of strings that occur
    twice among all regions; all starts of a region that has copies."""
    size = np.array([len(r) // search.width for r in regions], np.int64)
    begin = np.cumsum(size) - size
    end = begin + size
    data = np.frombuffer(b"".join(regions), search.dtype)
    if not len(data):
        return [np.empty(0, np.int64) for _ in regions]
    at = np.flatnonzero(_candidates(data, begin, end, search))
    owner = np.searchsorted(begin, at, "right") - 1
    order, first = _string_groups(*(gram_hashes(data, search.length, f)[at] for f in _FACTORS))
    total = np.add.reduceat(np.array(copies, np.int64)[owner[order]], first) if len(at) else np.empty(0, np.int64)
    hit = np.zeros(len(at), bool)
    hit[order] = np.repeat(total >= 2, np.diff(np.append(first, len(at))))
    at, owner = at[hit], owner[hit]
    edges = np.searchsorted(owner, np.arange(len(regions) + 1))
    return [np.arange(n_ - search.length + 1) if n > 1 else at[a:b] - s
            for n_, n, a, b, s in zip(size, copies, edges, edges[1:], begin, strict=False)]


_FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _string_groups(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans covered by strings at sorted starts."""
    if not len(starts):
        return starts, starts
    new = np.concatenate([[True], starts[1:] > starts[:-1] + length])
    first = np.flatnonzero(new)
    return starts[first], starts[np.append(first[1:], len(starts)) - 1] + length


def _span_table(kind: pa.DataType, ids, keys, which, begin, end) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, kind), "th": pa.array(keys, pa.binary()), "search": pa.array(which, pa.int32()),
                     "a": pa.array(begin, pa.int64()), "b": pa.array(end, pa.int64())})


def repeated_spans(texts: DataFrame, searches: tuple[Search, ...] = (byte_search(),),
                   hot_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, th, spans) of ``texts`` (doc_id, text, th), for documents with
    repeats; th tells rows of one doc_id apart.  A span (search, a, b) is a
    place in the symbols that the search makes of the text."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    arrow_kind = texts.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    sorts = len(searches)
    of_search = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("search") + 1)
    length_of = of_search([x.length for x in searches])

    def group_runs(k: int, group: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """(row, key, region hash, first start, start after the last) of the
        runs of short texts, searched as one array."""
        x, size = searches[k], np.array([len(d) for _, d in group])
        data = np.concatenate([d for _, d in group])
        key, a, b = runs_of(data, x, size)
        end = np.cumsum(size)
        owner = np.searchsorted(end, a, "right")
        at = (end - size)[owner]
        # a key tells its search: the remainder by their number
        return (np.array([row for row, _ in group])[owner], key - key % _U64(sorts) + _U64(k),
                region_hashes(data, a, b + x.length - 1), a - at, b - at)

    def find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, groups, held = [], [[] for _ in searches], [0] * sorts
            for row, text in enumerate(batch.column(1)):
                text = text.as_py()
                for k, x in enumerate(searches):
                    data = x.encode(text)
                    if len(data) < x.length:
                        continue
                    if groups[k] and held[k] + len(data) > GROUP_SYMBOLS:
                        found.append(group_runs(k, groups[k]))
                        groups[k], held[k] = [], 0
                    groups[k].append((row, data))
                    held[k] += len(data)
            found += [group_runs(k, group) for k, group in enumerate(groups) if group]
            if not found:
                continue
            at, key, region, begin, end = map(np.concatenate, zip(*found, strict=True))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(2).take(at), pa.array((key % _U64(sorts)).astype(np.int32)),
                 pa.array(key.view(np.int64)), pa.array(region.view(np.int64)),
                 pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
                names=["doc_id", "th", "search", "m", "r", "s", "e"])
        release_memory()

    runs = stored(texts.select("doc_id", "text", "th").mapInArrow(
        find_runs, f"doc_id {kind}, th binary, search int, m bigint, r bigint, s bigint, e bigint"), "dedup-runs")
    keys = runs.groupBy("m").agg(F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high"))
    keys = stored(keys.where("n > 1").select("m", (F.col("low") != F.col("high")).alias("mixed")), "dedup-keys")
    live = stored(runs.where(membership(keys)(F.col("m"))).join(keys, "m"), "dedup-runs")

    classes = live.where("mixed").groupBy("m", "r", "search").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "s", "e")).alias("own"))
    mixed = stored(classes.select("m", "r", "search", "n", "own.*"), "dedup-classes")
    again = live.where("mixed").join(mixed.where("n > 1").select("m", "r"), ["m", "r"])
    copied = live.where("not mixed").select(*again.columns).unionByName(again).select(
        "doc_id", "th", "search", F.col("s").alias("a"), (F.col("e") + length_of - 1).alias("b"))

    bytes_ = (F.col("e") - F.col("s") + length_of) * of_search([x.width for x in searches])
    heavy = mixed.groupBy("m").agg(F.sum(bytes_).alias("_bytes")).where(F.col("_bytes") > hot_bytes).select(
        "m", F.lit(True).alias("hot"))
    owned = mixed.join(heavy, "m", "left").groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("m", "search", "n", "s", "e", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("own"))
    owned = stored(owned, "dedup-owners")
    size, hot_starts = mixed.join(heavy, "m", "left").agg(
        F.coalesce(F.sum(F.when(F.col("hot").isNull(), bytes_)), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("hot"), F.col("e") - F.col("s"))), F.lit(0))).first()
    shards, hot_shards = max(16, -(-size // SHARD_BYTES)), max(4, -(-hot_starts * 3 * _U64(0).itemsize // SHARD_BYTES))
    owners = probable_owners(texts, owned)
    fetched = owners.alias("t").join(owned.alias("o"), F.col("t.doc_id").eqNullSafe(F.col("o.doc_id"))
                                     & (F.col("t.th") == F.col("o.th"))).select("t.doc_id", "t.th", "t.text", "o.own")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Regions to their key's shard; strings of hot keys, as hashes, to
        the shards of the hashes."""
        def sent(out: list[tuple]) -> pa.RecordBatch:
            types = (pa.int64(), arrow_kind, pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              names=["shard", "doc_id", "th", "search", "n", "s", "data"])

        for batch in batches:
            out: list[tuple] = []
            for doc, th, text, own in zip(*batch.columns, strict=True):
                doc, th, made = doc.as_py(), th.as_py(), {}
                for o in own.as_py():
                    k = o["search"]
                    if k not in made:
                        made[k] = searches[k].encode(text.as_py())
                    region = made[k][o["s"]:o["e"] + searches[k].length - 1]
                    if not o["hot"]:
                        out.append((o["m"] % shards, doc, th, k, o["n"], o["s"], region.tobytes()))
                    else:
                        h = np.column_stack([*(gram_hashes(region, searches[k].length, f) for f in _FACTORS),
                                             np.arange(o["s"], o["e"], dtype=_U64)])
                        to = (h[:, 0] % _U64(hot_shards)).astype(np.int64)
                        by = np.argsort(to, kind="stable")
                        targets, first = np.unique(to[by], return_index=True)
                        out += [(shards + int(t), doc, th, k, o["n"], o["s"], part.tobytes())
                                for t, part in zip(targets, np.split(h[by], first[1:]), strict=True)]
                    if len(out) >= ROWS_SENT:
                        yield sent(out)
                        out = []
            yield sent(out)
        release_memory()

    def sort_shard(group: pa.Table) -> pa.Table:
        """Spans of one search's regions in a shard."""
        ids, ths, n, s = (group.column(c).to_pylist() for c in ("doc_id", "th", "n", "s"))
        data, k = group.column("data").to_pylist(), group.column("search")[0].as_py()
        length, out = searches[k].length, []
        if group.column("shard")[0].as_py() >= shards:
            h = [np.frombuffer(d, _U64).reshape(-1, 3) for d in data]
            owner, h = np.repeat(np.arange(len(h)), [len(x) for x in h]), np.concatenate(h)
            order, first = _string_groups(h[:, 0], h[:, 1])
            total = np.add.reduceat(np.array(n, np.int64)[owner[order]], first)
            hit = order[np.repeat(total >= 2, np.diff(np.append(first, len(order))))]
            hit = hit[np.lexsort((h[hit, 2], owner[hit]))]
            edges = np.searchsorted(owner[hit], np.arange(len(data) + 1))
            found_at = [h[hit[a:b], 2].astype(np.int64) for a, b in zip(edges, edges[1:])]
        else:
            found_at = [x + b for x, b in zip(repeated_starts(data, n, searches[k]), s, strict=True)]
        for j, at in enumerate(found_at):
            if n[j] == 1:                               # copies are spans already
                out += [(ids[j], ths[j], k, a, b) for a, b in zip(*(x.tolist() for x in _spans(at, length)), strict=True)]
        found = _span_table(arrow_kind, *(zip(*out, strict=True) if out else [[]] * 5))
        del data, found_at
        release_memory()
        return found

    sorted_ = fetched.mapInArrow(cut, f"shard bigint, doc_id {kind}, th binary, search int, n bigint, s bigint, data binary"
                                 ).groupBy("shard", "search").applyInArrow(
        sort_shard, f"doc_id {kind}, th binary, search int, a bigint, b bigint")
    return stored(copied.unionByName(sorted_).groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_list(F.struct("search", "a", "b"))).alias("spans")), "dedup-spans")


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlap."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _of_search(spans: list[dict] | None, search: int) -> list[tuple[int, int]]:
    return _merge([(x["a"], x["b"]) for x in spans or [] if x["search"] == search])


def _places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of bytes of ``text`` for spans of its words."""
    at = [m.span() for m in _WORD.finditer(text.encode())] if spans else []
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


def _kept(text: str, spans: list[tuple[int, int]]) -> bytes:
    data, at, out = text.encode(), 0, []
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def _with_spans(texts: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``texts`` that may have spans, with them (null where there is none), and
    the others, which a bitmap lets past the join."""
    maybe = membership(spans.select(row_hash().alias("key")).distinct())
    marked = texts.withColumn("_maybe", maybe(row_hash()))
    s = spans.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "spans")
    met = marked.where("_maybe").join(s, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    return met.select(*texts.columns, "spans"), marked.where("not _maybe").select(*texts.columns)


def digests(docs: DataFrame, length: int = LENGTH, words: int = PASSAGE, hot_bytes: int = SHARD_BYTES,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    of the strings of ``length`` bytes, and n_passages, n_passage_words: what
    runs of ``words`` words that repeat would take further."""
    texts = keyed(id_text(docs, id_col, text_col))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                found = found.as_py()
                spans, passages = _of_search(found, 0), _of_search(found, 1)
                kept = _kept(text.as_py(), spans)
                gone = sum(b - a for a, b in spans)
                out.append((len(kept) + gone, gone, len(spans), hashlib.sha256(kept).hexdigest(), len(passages),
                            sum(b - a for a, b in passages)))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "n_passage_words"])
        release_memory()

    spans = repeated_spans(texts, (byte_search(length), word_search(words)), hot_bytes)
    met, past = _with_spans(texts, spans)
    cut = met.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
             "n_passages bigint, n_passage_words bigint")
    none = F.lit(0).cast("bigint")
    return cut.unionByName(past.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), none.alias("n_passages"), none.alias("n_passage_words")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   words: int | None = None) -> DataFrame:
    """``docs`` without the repeated bytes of ``text_col``; a character cut in
    two goes as a whole, a null text stays null, other columns are untouched.
    With ``words``, runs of that many words that repeat are cut as well."""
    others = [c for c in docs.columns if c != text_col]
    row = F.struct(F.col(text_col).isNull().alias("is_null"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)))
    texts = keyed(docs.select(row.alias("row"), F.col(id_col).alias("doc_id"),
                               F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    searches = (byte_search(length), word_search(words)) if words else (byte_search(length),)
    spans = repeated_spans(texts.select("doc_id", "text", "th"), searches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for t, found in zip(batch.column(1), batch.column(2), strict=True):
                text, found = t.as_py(), found.as_py()
                if found:
                    cut = _of_search(found, 0) + _places(text, _of_search(found, 1))
                    text = _kept(text, _merge(sorted(cut))).decode("utf-8", "ignore")
                kept.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["row", "kept"])
        release_memory()

    met, past = _with_spans(texts, spans)
    cut = met.select("row", "text", "spans").mapInArrow(run, f"row {met.schema['row'].dataType.simpleString()}, kept string")
    cut = cut.unionByName(past.select("row", F.col("text").alias("kept")))
    place = {c: F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(others)}
    kept = F.when(~F.col("row.is_null"), F.col("kept")).alias(text_col)
    return cut.select(*(place.get(c, kept) for c in docs.columns))


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
