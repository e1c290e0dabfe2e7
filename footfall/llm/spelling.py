"""Spelling variants: words one edit apart, found by scanning sorted lists.

**Vocabulary.**  Words are counted inside each task per document and batch,
so a common word is one row a task before anything is shuffled.

**Lists.**  Two words one edit apart agree on half of the shorter one, at its
front or at its back.  A word is filed under both halves, once as the shorter
word of a pair and once as the longer, and only what the half leaves open (the
rest) is compared.  A list whose rests fill more than LIST_CELLS characters is
cut again the same way (half of what is still open must agree, too), until it
fits: what is open shrinks to one character, where the alphabet bounds the
list.  A pair is counted in the first of the lists that it shares.

**Scan.**  A list is sorted; neighbours' common prefixes (LCPs) cut it into
nested ranges of words with one prefix.  The edit matrix of a query against a
list word needs a band of three cells a row, and the rows of a shared prefix
are computed once for the whole range; a range whose row has no cell below
two is skipped with everything in it.  All queries of a task go down the
ranges together, one row of the matrices a step, as numpy arrays; where that
makes more than MOST_RANGES pairs, the queries go down in two halves.

**Forms.**  A word's form is its commonest near word if that is FACTOR times
as common.  Counts rise along a chain of forms, so chains are short; they are
followed by joins that double the step.

Defined results: a null text has no words; a null id takes part as the empty
text; repeated rows count as often as they occur; ties of the count go to the
smaller word in code-point order; extra columns are ignored; an empty table
gives no rows; very long texts are read whole, one at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm import sql
from footfall.llm.common import stored, table, tasks_for

LEAST_LENGTH = 7
LEAST_COUNT = 2
FACTOR = 10
NOISE = 31                    # a word of a document loses a character when this divides its checksum
HELD_WORDS = 200_000          # words counted in a task before they are sent on
LIST_CELLS = 1 << 14          # characters of a list's rests that are scanned together at most
SCAN_CELLS = 1 << 18          # characters of the lists that one step scans
MOST_RANGES = 1 << 18         # (query, range) pairs that one step of a scan holds
ROWS_PER_TASK = 100_000
NO_LIMIT = 1 << 30


# --- vocabulary -------------------------------------------------------------

def occurrences(doc_id: object, text: str, least_length: int, noise: int) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of a text, words in Latin-1: the runs of letters,
    A-Z lowered.  With ``noise``, a word whose checksum it divides loses the
    character that the checksum points at.  What Latin-1 lacks becomes a
    question mark and parts words, as it should."""
    letters = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least_length)
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(letters.findall(text.encode("latin-1", "replace").lower())).items():
        if noise:
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
            if h % noise == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
                if len(word) < least_length:
                    continue
        yield word, n


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = 0,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that occur ``least_count`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if text:
                    for word, n in occurrences(doc_id, text, least_length, noise):
                        held[word] = held.get(word, 0) + n
                    if len(held) >= HELD_WORDS:
                        yield flush()
        yield flush()

    rows = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- lists ------------------------------------------------------------------

def _filed(words: DataFrame, least_length: int) -> DataFrame:
    """Words under the front and the back half, for both roles: ``least`` is
    the length of the shorter word of a pair, ``key`` the list, ``rest`` what
    the list leaves open.  A pair whose rests share ``limit`` characters or
    more at the front is counted in another list."""
    length = F.length("word")
    rows = words.withColumn("least", F.explode(F.array(length, length - 1))).where(F.col("least") >= least_length)
    return _halved(rows.select("*", F.col("word").alias("rest"), F.lit("").alias("key"), F.lit(NO_LIMIT).alias("limit")))


def _halved(rows: DataFrame) -> DataFrame:
    """Rows of lists filed under the halves of what is open.  Words that agree
    on the front half meet there; the back half's list leaves them out."""
    shorter_open = F.col("least") - F.length("word") + F.length("rest")
    rows = rows.withColumn("_half", F.floor(shorter_open / 2).cast("int")).withColumn("_size", F.length("rest"))
    half, size = F.col("_half"), F.col("_size")

    def cut(mark: str, held: Column, rest: Column, limit: Column) -> Column:
        return F.struct(F.concat("key", F.lit(mark), held).alias("key"), rest.alias("rest"), limit.alias("limit"))

    none = F.col("limit") == NO_LIMIT
    front = cut("<", F.substring("rest", F.lit(1), half), F.substring("rest", half + 1, size),
                F.when(none, F.lit(NO_LIMIT)).otherwise(F.col("limit") - half))
    back = cut(">", F.substring("rest", size - half + 1, half), F.substring("rest", F.lit(1), size - half),
               F.least("limit", half))
    return (rows.withColumn("_cut", F.explode(F.array(front, back))).select("word", "n", "least", "_cut.*")
            .where(F.col("limit") > 0))


def lists(words: DataFrame, least_length: int = LEAST_LENGTH, cells: int = LIST_CELLS) -> Iterator[tuple[DataFrame, int]]:
    """(rows, their number) of the lists that fit, cut by cut; lists of one
    word are left out."""
    rows = _filed(words, least_length)
    while True:
        rows = stored(rows, "spelling-lists")
        sizes = rows.groupBy("least", "key").agg(F.count("*").alias("_n"), F.sum(F.length("rest")).alias("_cells"),
                                                 F.max(F.length("rest")).alias("_open")).where("_n > 1")
        big = (F.col("_cells") > cells) & (F.col("_open") > 2)
        sizes = stored(sizes.select("least", "key", "_n", big.alias("_big")), "spelling-sizes")
        number = {r["_big"]: r["n"] for r in sizes.groupBy("_big").agg(F.sum("_n").alias("n")).collect()}
        if False in number:
            yield rows.join(sizes.where("not _big").select("least", "key"), ["least", "key"]), number[False]
        if True not in number:
            return
        rows = _halved(rows.join(sizes.where("_big").select("least", "key"), ["least", "key"]))


# --- scan -------------------------------------------------------------------

class Scan:
    """Lists side by side: row k has the characters ``chars[k]`` (0 behind the
    end) of its rest; ``first`` marks the first row of a list."""

    def __init__(self, rests: list[str], first: np.ndarray):
        self.size = np.array([len(r) for r in rests], np.int64)
        width = int(self.size.max(initial=0)) + 2
        self.chars = np.zeros((len(rests), width), np.uint32)
        self.chars[np.arange(width) < self.size[:, None]] = np.frombuffer("".join(rests).encode("utf-32-le"), np.uint32)
        self.lcp = np.full(len(rests), -1, np.int64)
        if len(rests) > 1:
            same = self.chars[1:] == self.chars[:-1]
            self.lcp[1:] = np.where(same.all(axis=1), width, same.argmin(axis=1))
        self.lcp[first] = -1

    def pairs(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, row of its list) of all pairs exactly one edit apart."""
        total = len(self.size)
        starts = np.flatnonzero(self.lcp < 0)
        ends = np.append(starts[1:], total)
        home = np.searchsorted(starts, queries, "right") - 1
        q, s, e = queries, starts[home], ends[home]
        row = [np.full(len(q), 2, np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)]
        found_q, found_w = [], []
        open_ = [(q, s, e, row, 0)]
        while open_:
            q, s, e, row, depth = open_.pop()
            begins = np.flatnonzero(self.lcp <= depth)                 # ranges of depth + 1 characters
            low, high = np.searchsorted(begins, s), np.searchsorted(begins, e)
            n = high - low
            if len(q) > 1 and n.sum() > MOST_RANGES:
                mid = len(q) // 2
                open_ += [(q[h], s[h], e[h], [x[h] for x in row], depth) for h in (slice(mid, None), slice(mid))]
                continue
            at = np.repeat(np.arange(len(q)), n)                       # range -> the ranges in it
            child = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + low[at]
            s = begins[child]
            e = np.append(begins, total)[child + 1]
            q = q[at]
            a, b, c = (x[at] for x in row)
            letter = self.chars[s, depth]
            ended = letter == 0
            if ended.any():                                            # a list word of ``depth`` characters
                gap = self.size[q] - depth
                cell = np.where(gap == 0, b, np.where(gap == 1, c, np.where(gap == -1, a, 2)))
                hit = ended & (cell == 1)
                found_q.append(q[hit]), found_w.append(s[hit])
            x = np.minimum(a + (letter != self.chars[q, max(depth - 1, 0)]), b + 1)
            y = np.minimum(np.minimum(b + (letter != self.chars[q, depth]), c + 1), x + 1)
            last = min(depth + 1, self.chars.shape[1] - 1)
            z = np.minimum(c + (letter != self.chars[q, last]), y + 1)
            live = ~ended & (np.minimum(np.minimum(x, y), z) <= 1)
            q, s, e = q[live], s[live], e[live]
            if len(q):
                open_.append((q, s, e, [np.minimum(v[live], 2).astype(np.int8) for v in (x, y, z)], depth + 1))
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *found_q]), np.concatenate([none, *found_w])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of rows."""
        same = self.chars[a] == self.chars[b]
        return np.where(same.all(axis=1), self.chars.shape[1], same.argmin(axis=1))


def _scan(rows: pa.Table) -> pa.RecordBatch:
    """Near words of whole lists, sorted by list and rest: for every word its
    near words here, the commonest of them and its count."""
    least, key, word, n = (rows[c].combine_chunks() for c in ("least", "key", "word", "n"))
    least, n, limit = least.to_numpy(), n.to_numpy(), rows["limit"].to_numpy()
    first = np.ones(len(n), bool)
    if len(n) > 1:
        first[1:] = (least[1:] != least[:-1]) | pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    scan = Scan(rows["rest"].to_pylist(), np.flatnonzero(first))
    size = pc.utf8_length(word).to_numpy()
    q, w = scan.pairs(np.flatnonzero(size == least))       # the shorter word asks
    fresh = scan.common(q, w) < limit[q]
    q, w = q[fresh], w[fresh]
    longer = size[w] > size[q]
    a, b = np.concatenate([q, w[longer]]), np.concatenate([w, q[longer]])
    place = np.empty(len(n), np.int64)                     # in code-point order
    place[pc.sort_indices(word).to_numpy()] = np.arange(len(n))
    order = np.lexsort((place[b], -n[b], a))
    a, b = a[order], b[order]
    at = np.flatnonzero(np.diff(a, prepend=-1))
    counts = np.diff(np.append(at, len(a)))
    return pa.RecordBatch.from_arrays(
        [word.take(pa.array(a[at])), pa.array(counts.astype(np.int64)), word.take(pa.array(b[at])), pa.array(n[b[at]])],
        names=["word", "n_near", "form", "form_n"])


def _scanned(rows: DataFrame, number: int) -> DataFrame:
    """Partitions hold whole lists in order; lists are scanned as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            piece = pa.table(batch)
            held = piece if held is None else pa.concat_tables([held, piece])
            if pc.sum(pc.utf8_length(held["rest"])).as_py() < SCAN_CELLS:
                continue
            last = held.num_rows - 1
            ours = pc.and_(pc.equal(held["least"], held["least"][last]), pc.equal(held["key"], held["key"][last]))
            cut = int(np.flatnonzero(ours.to_numpy())[0])              # the last list may go on
            if cut:
                yield from _steps(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from _steps(held)

    def _steps(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        """Lists of similar length together: a step's matrix has little padding."""
        width = pc.utf8_length(whole["rest"]).to_numpy() + 2
        least = whole["least"].to_numpy()
        key = whole["key"].combine_chunks()
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        edges = [*np.flatnonzero(new), len(least)]
        a, widest = 0, 0
        for lo, hi in zip(edges, edges[1:]):
            wide = max(widest, int(width[lo:hi].max()))
            if lo > a and (hi - a) * wide > SCAN_CELLS:
                yield _scan(whole.slice(a, lo - a))
                a, wide = lo, int(width[lo:hi].max())
            widest = wide
        yield _scan(whole.slice(a))

    parts = tasks_for(rows.sparkSession, number, ROWS_PER_TASK)
    dealt = (rows.select("least", "key", "rest", "word", "n", "limit").repartition(parts, "least", "key")
             .sortWithinPartitions("least", "key", "rest"))
    return dealt.mapInArrow(run, "word string, n_near bigint, form string, form_n bigint")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, cells: int = LIST_CELLS) -> DataFrame:
    """(word, n, n_near, form, form_n) of ``words`` (word, n): near words and
    the commonest one, whatever its count; 0 and nulls where there is none."""
    words = stored(words, "spelling-words")
    found = None
    for rows, number in lists(words, least_length, cells):
        part = stored(_scanned(rows, number), "spelling-near")
        found = part if found is None else found.unionByName(part)
    if found is None:                                  # no list of two words
        return words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("string").alias("form"),
                            F.lit(None).cast("bigint").alias("form_n"))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("form_n")).alias("k"), F.col("form"))).alias("best"))
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("best.form").alias("form"),
        (-F.col("best.k")).alias("form_n"))


def rooted(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ...) with ``root``, the end of the chain of
    forms; chains must end.  Steps double, so few joins follow any chain."""
    forms = stored(forms, "spelling-forms")
    step = stored(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = step.join(ahead, "root", "left")
        nxt = stored(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_on")),
                     "spelling-roots")
        going = not nxt.where("_on").isEmpty()
        step = nxt.drop("_on")
        if not going:
            break
    return forms.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(words: DataFrame, factor: int = FACTOR, least_length: int = LEAST_LENGTH, cells: int = LIST_CELLS) -> DataFrame:
    """One row a word: its form (the commonest near word if ``factor`` times
    as common), the root that forms lead to, and the counts."""
    near = near_words(words, least_length, cells)
    common = F.col("form_n") >= factor * F.col("n")
    forms = near.withColumn("form", F.when(common, F.col("form"))).withColumn("form_n", F.when(common, F.col("form_n")))
    return rooted(forms).select("word", "form", "root", "n", "n_near", "form_n")


def query(spark, sf_dir):
    return variants(vocabulary(table(spark, sf_dir, "documents"), noise=NOISE))


ORACLE = f"""
WITH RECURSIVE {sql.CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all({sql.ascii_lower("text")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS word FROM documents),
long_runs AS (
    SELECT doc_id, word, count(*) AS n FROM runs WHERE length(word) >= {LEAST_LENGTH} GROUP BY ALL),
drawn AS (
    SELECT word, n, {sql.crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word")} AS h FROM long_runs, crc_table),
spelt AS (
    SELECT n, CASE WHEN h % {NOISE} = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2)
                   ELSE word END AS word FROM drawn),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt
    WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
gaps AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.less
    UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.less),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {FACTOR} * w.n THEN form END AS form,
           CASE WHEN form_n >= {FACTOR} * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
chain(word, root, k) AS (
    SELECT word, word, 0 FROM forms
    UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word) c USING (word)
"""
