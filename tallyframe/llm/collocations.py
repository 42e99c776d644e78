"""Phrase collocations from a weighted de Bruijn graph of words (operator 12).

Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words
``[^\\x20\\x09]+`` (A-Z lower-cased); everything is per language.  In the graph
of order k a node is a phrase of k words and an edge, a phrase of k + 1 words,
leads from its first k words to its last k.

1. **Longest grams.**  Only the edges of the highest order (five words) are
   counted in the texts, together with the ends of pieces: the last one to
   four words of each, where no edge goes on (:func:`grams`).
2. **Node flow.**  All shorter counts follow without another look at the
   texts: the occurrences of a node are the flow through its outgoing edges
   plus the pieces that end in it (:func:`flows`), from order four down to
   the words.
3. **Unary paths.**  A node whose whole flow comes in, or goes out, through
   one edge is part of that longer phrase and nothing else; such nodes are
   compacted into their edge (:func:`branching`).  What remains are the
   phrases that some longer phrase does not account for.
4. **Scores.**  Every cut of a phrase compares its count with those of its two
   parts; whole numbers of up to 38 digits throughout (:func:`scored`).

Before the first step, words and pairs of neighbours are counted in a table
of hashed cells (:class:`Frequent`), merged over all data, and then the grams
of three to five words that consist of frequent pairs in a second one.  A cell
below ``least`` proves that nothing through it is a candidate or a part of
one, so the chain is broken there as at the end of a piece.  Counts of
everything that can be returned stay exact: no frequent phrase crosses a
broken place.

Scale: a task adds up the distinct grams of its slices and Spark adds up what
the tasks send, so a hot phrase costs a task a row.  Small splits share a task
(``task_bytes``), so more text does not mean as many more senders of the same
grams; a full task (``held_rows``) sends the rarer ones and keeps the others.
The cells are bounded (``most_bits``; beyond it the table only lets more through), and are
merged in levels of ``fan_in`` messages.  Look-ups of parts, where one common
word meets many phrases, use the skew-split join.  Ranking cuts each
language's phrases down in hashed shares first.

Defined cases: a null text is empty; a null language is ``und``; repeated
rows count as often as they occur; an empty table gives an empty result;
other columns are ignored, whatever their names; a text of any length is cut
at its pieces, so memory follows the longest piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm import arrays as A
from tallyframe.llm import mail as M
from tallyframe.llm.shared import stored
from tallyframe.operators.joins import skew_split_join

U64 = A.U64
ORDER = 5                                   # words of the longest grams
GAP = np.zeros(256, bool)
GAP[[0x20, 0x09]] = True
STOP = np.zeros(256, bool)
STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
OTHER = np.uint8(0xA5)                      # bytes exchanged for a second, independent hash
WORD_SALT, PAIR_SALT, GRAM_SALT, AGAIN_SALT, LONG_SALT = 41, 42, 43, 44, 50
MULTIPLY = U64(0x9E3779B97F4A7C15)
NUMBER = "decimal(38,0)"


@dataclass(frozen=True)
class Settings:
    least: int = 100          # occurrences of a candidate
    top: int = 2000           # phrases returned per language
    slice_bytes: int = 4 << 20
    most_bits: int = 30       # 2 ** most_bits cells at most (one bit each once merged)
    least_bits: int = 16
    slices: int = 64          # of the cells, merged apart
    fan_in: int = 256         # messages that one merge reads, about
    held_rows: int = 1_000_000  # grams that a task adds up before it sends them
    task_bytes: int = 128 << 20  # of text that one such task reads, where there are cores enough
    hot_rows: int = 100_000   # rows of one key in a look-up before it is split
    shares: int = 256         # of a language's phrases, ranked apart first


# ---- words of a batch ----------------------------------------------------

def piece_slices(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` bytes that end behind a stop or a document."""
    a, n = 0, len(data)
    while a < n:
        b = min(a + size, n)
        if b < n:
            later = offsets[np.searchsorted(offsets, b):]
            end = int(later[0]) if len(later) else n
            while b < end:
                c = min(b + 65536, end)
                stops = np.flatnonzero(STOP[data[b:c]])
                if len(stops):
                    end = b + int(stops[0]) + 1
                b = c
            b = end
        yield a, b
        a = b


@dataclass
class Words:
    """Words of one slice: their bytes' bounds, document, and whether the next one is in the same piece."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    joined: np.ndarray        # len(starts) - 1 entries


def words_of(data: np.ndarray, offsets: np.ndarray, a: int, b: int) -> Words:
    d = A.LOWER[data[a:b]]
    stop = STOP[d]
    black = ~(GAP[d] | stop)
    edge = offsets[(offsets > a) & (offsets < b)] - a
    first, last = np.empty(b - a, bool), np.empty(b - a, bool)
    first[0] = last[-1] = True
    np.logical_not(black[:-1], out=first[1:])
    np.logical_not(black[1:], out=last[:-1])
    first[edge] = True
    last[edge - 1] = True
    starts, ends = np.flatnonzero(first & black), np.flatnonzero(last & black) + 1
    doc = np.searchsorted(offsets, starts + a, side="right") - 1
    piece = np.cumsum(stop, dtype=np.int32)[starts]
    joined = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1]) if len(starts) else np.zeros(0, bool)
    return Words(d, starts, ends, doc, joined)


def batch_words(batch: pa.RecordBatch, size: int) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """Per slice of a (lang, text) batch: its words, the language number of each document, and the languages."""
    langs = batch.column(0).cast(pa.string()).fill_null("und").dictionary_encode()
    names, number = langs.dictionary.to_pylist(), langs.indices.to_numpy()
    data, offsets = A.text_bytes(batch.column(1))
    for a, b in piece_slices(data, offsets, size):
        w = words_of(data, offsets, a, b)
        if len(w.starts):
            yield w, number[w.doc], names


def language_values(names: list[str]) -> np.ndarray:
    """A 64-bit value per language, the same in every batch."""
    raw = [n.encode() for n in names]
    bounds = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    value = np.full(len(raw), 0x1F, U64)
    some = bounds[1:] > bounds[:-1]
    value[some] = A.run_hashes(data, bounds[:-1][some], bounds[1:][some])
    return A.mix(value, 5)


def keys_of(w: Words, lang: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word within its language, the word's cell key, and that of each pair of neighbours."""
    h = A.run_hashes(w.data, w.starts, w.ends) ^ language_values(names)[lang]
    return h, A.mix(h, WORD_SALT), A.mix(h[:-1] * MULTIPLY + h[1:], PAIR_SALT)


# ---- tables of cells ----------------------------------------------------------

Keys = Callable[[Words, np.ndarray, list[str]], list[np.ndarray]]


class Frequent:
    """Hashed cells whose keys occur at least ``least`` times together; may hold rare keys, misses no frequent one.

    ``keys`` lists the key arrays of a slice that are counted.
    """

    def __init__(self, texts: DataFrame, total: int, keys: Keys, settings: Settings):
        s = settings
        bits = self.bits = min(s.most_bits, max(s.least_bits, (total // 16).bit_length()))
        slices, width = s.slices, bits - (s.slices.bit_length() - 1)
        parts = max(1, -(-total // (s.slice_bytes * s.fan_in)))
        shift, size, least = U64(64 - bits), s.slice_bytes, s.least

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for w, lang, names in batch_words(batch, size):
                    every = keys(w, lang, names)
                    part = int(w.starts.sum() + w.ends[-1]) % parts          # by content: the same on every run
                    cells, counts = np.unique(np.concatenate(every) >> shift, return_counts=True)
                    yield from sent(cells, counts, width, slices, lambda k: k * parts + part).to_batches()

        def merge(now: int, after: int):
            """Adds up the messages of one slice and part; after the last level, keeps a bit per frequent cell."""
            def run(key: int, table: pa.Table) -> pa.Table:
                sums = np.zeros(1 << width, np.int64)
                for _, (steps, n) in M.received(table):
                    sums[np.cumsum(steps, dtype=np.int64)] += n
                if after == 0:
                    return M.messages([(key, 0, M.pack(np.packbits(sums >= least)))])
                cell, part = np.flatnonzero(sums), key % now // s.fan_in
                return sent(cell, np.minimum(sums[cell], least), width, 1, lambda _: key // now * after + part)
            return run

        asked = texts.mapInArrow(count, M.MESSAGES)
        while parts > 1:
            fewer = -(-parts // s.fan_in)
            asked, parts = M.answer(asked, merge(parts, fewer)), fewer
        cells = np.zeros((1 << bits) // 8, np.uint8)
        each = (1 << width) // 8
        for r in M.answer(asked, merge(1, 0)).collect():      # 2 ** most_bits / 8 bytes at most
            cells[r["__tf_to"] * each : (r["__tf_to"] + 1) * each] = M.unpack(r["__tf_payload"])[0]
        self.cells = texts.sparkSession.sparkContext.broadcast(cells)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        c = keys >> U64(64 - self.bits)
        return (self.cells.value[(c >> U64(3)).astype(np.int64)] >> (7 - (c & U64(7))).astype(np.uint8)) & 1 == 1


def sent(cells: np.ndarray, counts: np.ndarray, width: int, slices: int, address: Callable[[int], int]) -> pa.Table:
    """One message per slice of rising cells: steps from one cell to the next, and counts."""
    cells = cells.astype(np.int64)
    edges = np.searchsorted(cells, np.arange(slices + 1, dtype=np.int64) << width)
    rows = []
    for k in range(slices):
        a, b = edges[k], edges[k + 1]
        if b > a:
            steps = np.diff(cells[a:b], prepend=k << width).astype(np.uint32)
            rows.append((address(k), 0, M.pack(steps, counts[a:b].astype(np.uint32))))
    return M.messages(rows)


# ---- the longest grams of a slice -------------------------------------------

def words_and_pairs(w: Words, lang: np.ndarray, names: list[str]) -> list[np.ndarray]:
    _, word, pair = keys_of(w, lang, names)
    return [word, pair[w.joined]]


class Chains:
    """Where frequent words and pairs follow each other, and the grams on them."""

    def __init__(self, w: Words, lang: np.ndarray, names: list[str], pairs: Frequent):
        self.h, word, pair = keys_of(w, lang, names)
        self.common = pairs(word)
        joined = w.joined & pairs(pair)
        self.length = np.ones(len(self.h), np.int64)            # words of the gram from each word: up to ORDER
        for k in range(1, ORDER):
            on = np.zeros(len(self.h), bool)
            on[: max(0, len(on) - k)] = joined[k - 1 :]
            self.length += (self.length == k) & on

    def longer(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For three words and more: where such a gram starts, and its key."""
        at = np.flatnonzero(self.length > 2)
        key = self.h[at] * MULTIPLY + self.h[at + 1]
        for k in range(3, ORDER + 1):
            on = self.length[at] >= k
            at, key = at[on], key[on] * MULTIPLY
            key = key + self.h[at + k - 1]
            yield k, at, A.mix(key, LONG_SALT + k)

    def shorten(self, grams: Frequent) -> None:
        """Ends each gram before the first word that makes it rare."""
        for k, at, key in list(self.longer()):
            rare = at[~grams(key)]
            self.length[rare] = np.minimum(self.length[rare], k - 1)


def gram_hash(h: np.ndarray, length: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the gram of ``length`` words that starts at each word."""
    out = h + length.astype(U64)
    for k in range(1, ORDER):
        more = np.flatnonzero(length > k)
        out[more] = out[more] * MULTIPLY + h[more + k]
    return A.mix(out, salt)


def gram_texts(w: Words, first: np.ndarray, length: np.ndarray) -> pa.Array:
    """Each gram's words joined by one space."""
    if not len(first):
        return pa.array([], pa.string())
    gram = np.repeat(np.arange(len(first)), length)
    begin = np.cumsum(length) - length
    nth = np.arange(len(gram)) - begin[gram]
    word = first[gram] + nth
    size = w.ends[word] - w.starts[word] + (nth < length[gram] - 1)      # with the space behind all but the last
    at = np.cumsum(size) - size
    source = np.repeat(w.starts[word] - at, size) + np.arange(int(size.sum()))
    data = w.data[np.minimum(source, len(w.data) - 1)]
    spaces = (at + size - 1)[nth < length[gram] - 1]
    data[spaces] = 0x20
    offsets = np.append(at[begin], size.sum()).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.string())


GRAMS = "lang string, gram string, words int, n long"
_SCHEMA = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("words", pa.int32()), ("n", pa.int64())])


def slice_grams(w: Words, lang: np.ndarray, names: list[str], pairs: Frequent, longer: Frequent) -> pa.RecordBatch:
    """Distinct longest grams of a slice with their counts; a gram without words has the number of all words."""
    chains = Chains(w, lang, names, pairs)
    chains.shorten(longer)
    h, length = chains.h, chains.length
    some = np.flatnonzero(chains.common)
    h2 = np.zeros(len(h), U64)
    inside = np.zeros(len(h) + ORDER, bool)
    for k in range(ORDER):
        inside[some[length[some] > k] + k] = True
    inside = np.flatnonzero(inside)
    h2[inside] = A.run_hashes(w.data ^ OTHER, w.starts[inside], w.ends[inside]) if len(inside) else 0
    one, two = gram_hash(h, length, GRAM_SALT)[some], gram_hash(h2, length, AGAIN_SALT)[some]
    order = np.argsort(one)
    cuts = A.group_starts(one[order], two[order])
    counts = np.diff(np.append(cuts, len(order)))
    first = some[order[cuts]]
    totals = np.bincount(lang, minlength=len(names))
    present = np.flatnonzero(totals)
    texts = pa.concat_arrays([gram_texts(w, first, length[first]), pa.array([""] * len(present), pa.string())])
    which = np.concatenate([lang[first], present])
    return pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()).take(pa.array(which)), texts,
        pa.array(np.concatenate([length[first], np.zeros(len(present), np.int64)]), pa.int32()),
        pa.array(np.concatenate([counts, totals[present]]), pa.int64())], schema=_SCHEMA)


def combined(tables: list[pa.Table]) -> pa.Table:
    """Equal grams of several slices added up."""
    return pa.concat_tables(tables).group_by(["lang", "gram", "words"]).aggregate([("n", "sum")]).rename_columns(["lang", "gram", "words", "n"]).cast(_SCHEMA)


def sent_grams(docs: DataFrame, settings: Settings = Settings(), lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, words, n) as the tasks send it: a gram once per task, more often only where a task overflows.

    Every task sends about every common gram, so small splits are read
    together, up to ``task_bytes``, by one task per core or more.
    """
    s = settings
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where(F.length("text") > 0)
    total, size = M.text_size(docs, text), s.slice_bytes
    pairs = Frequent(texts, total, words_and_pairs, s)
    longer = Frequent(texts, total, lambda w, number, names: [key for _, _, key in Chains(w, number, names, pairs).longer()], s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for w, number, names in batch_words(batch, size):
                held.append(pa.Table.from_batches([slice_grams(w, number, names, pairs, longer)]))
                if sum(t.num_rows for t in held) >= s.held_rows:
                    held = [combined(held)]
                    if 2 * held[0].num_rows >= s.held_rows:
                        order = pc.array_sort_indices(held[0]["n"], order="descending")
                        hot = s.held_rows // 4                       # the most frequent ones come again: kept
                        yield from held[0].take(order[hot:]).to_batches()
                        held = [held[0].take(order[:hot])]
        if held:
            yield from combined(held).to_batches()

    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-total // s.task_bytes))
    return texts.coalesce(tasks).mapInArrow(run, GRAMS)


def grams(docs: DataFrame, settings: Settings = Settings(), lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, words, n): edges of the highest order, shorter grams where a chain ends, and, with 0 words, all words."""
    return sent_grams(docs, settings, lang, text).groupBy("lang", "gram", "words").agg(F.sum("n").alias("n"))


# ---- the graph ----------------------------------------------------------------

def first_words(gram: Column | str, k: int) -> Column:
    return F.substring_index(gram, " ", k)


def flows(edges: DataFrame) -> dict[int, DataFrame]:
    """Per number of words the (lang, gram, n) of that order: flow of the edges that leave a node plus ends in it."""
    out = {ORDER: edges.where(F.col("words") == ORDER).select("lang", "gram", "n")}
    for k in range(ORDER - 1, 0, -1):
        leaving = out[k + 1].select("lang", first_words("gram", k).alias("gram"), "n")
        ends = edges.where(F.col("words") == k).select("lang", "gram", "n")
        out[k] = stored(leaving.unionByName(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    return out


def branching(nodes: DataFrame, edges: DataFrame, k: int) -> DataFrame:
    """The nodes (lang, gram, n) of ``k`` words that no single edge accounts for wholly, in or out."""
    most = F.lit(0).cast("bigint")
    through = edges.select("lang", F.explode(F.array(first_words("gram", k), F.substring_index("gram", " ", -k))).alias("gram"),
                           most.alias("n"), F.col("n").alias("edge"))
    both = nodes.select("lang", "gram", "n", most.alias("edge")).unionByName(through)
    return both.groupBy("lang", "gram").agg(F.max("n").alias("n"), F.max("edge").alias("edge")) \
        .where((F.col("n") > 0) & (F.col("edge") < F.col("n"))).select("lang", "gram", "n")


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame, settings: Settings) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): each phrase at the cut of least score, the first of ties."""
    cuts = phrases.select("lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), F.posexplode(
        F.expr("transform(sequence(1, words - 1), k -> struct(substring_index(gram, ' ', k) as head, substring_index(gram, ' ', k - words) as tail))")
    ).alias("cut", "part")).select("lang", "phrase", "a", "cut", "part.head", "part.tail")
    hot = settings.hot_rows
    for part, out in (("head", "l"), ("tail", "r")):
        cuts = skew_split_join(cuts, counts.select("lang", F.col("gram").alias(part), F.col("n").alias(out)), ["lang", part], hot_rows=hot)
    rows = skew_split_join(cuts, totals, "lang", hot_rows=hot)
    up = F.lit(1000).cast("decimal(4,0)") * (F.col("a").cast("decimal(17,0)") * F.col("n").cast("decimal(17,0)"))
    down = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    rows = rows.withColumn("__up", up.cast(NUMBER)).withColumn("__down", down.cast(NUMBER)) \
        .withColumn("score", F.expr("__up div __down"))
    least = F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b")
    return rows.groupBy("lang", "phrase").agg(least).select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def ranked(rows: DataFrame, settings: Settings) -> DataFrame:
    """The first ``top`` phrases of each language with their rank; shares of a language are cut first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    share = F.pmod(F.xxhash64("phrase"), F.lit(settings.shares))
    cut = rows.withColumn("__share", share)
    for by in (["lang", "__share"], ["lang"]):
        cut = cut.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")) \
            .where(F.col("rank") <= settings.top)
    return cut.drop("__share")


def collocations(docs: DataFrame, settings: Settings = Settings(), lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two to five words."""
    s = settings
    edges = stored(grams(docs, s, lang, text))
    orders = flows(edges)
    heavy = {k: df.where(F.col("n") >= s.least) for k, df in orders.items()}
    phrases = heavy[ORDER].withColumn("words", F.lit(ORDER))
    for k in range(2, ORDER):
        phrases = phrases.unionByName(branching(heavy[k], heavy[k + 1], k).withColumn("words", F.lit(k)))
    counts = heavy[1]
    for k in range(2, ORDER):
        counts = counts.unionByName(heavy[k])
    totals = edges.where(F.col("words") == 0).select("lang", "n")
    rows = scored(stored(phrases), stored(counts), totals, s)
    return ranked(rows, s).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
