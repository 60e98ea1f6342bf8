"""Ranked lexical search over max-sketches of documents.

    build_index   one row per document: its distinct terms with their frequencies, and a
                  sketch, frequencies folded into coordinates by a hash of the term, of which
                  each coordinate keeps the maximum
    search        queries in batches: the frequencies at a query's coordinates give an upper
                  bound of a document's score; documents are scored exactly from the highest
                  bound down, until no bound reaches the k-th best score any more

The score grows with a term's frequency, so the maximum at a coordinate is never less than
what any term there adds: a bound is never below the score, and no document is lost. A
sketch has ``SPREAD`` coordinates for every distinct term, a byte each; a frequency too
large for a byte stands for an infinite one. What a term weighs, and what a document's
length means, follows from numbers of the whole corpus, which a pass over the index counts
for the terms of a batch alone; the index itself holds nothing of the queries or the corpus.

A batch is a bounded number of queries and is sent to every task. Each task keeps the k best
documents of every query over all it has read; their worst score is the floor a bound has to
reach. The rows that tasks give out are counted in queries, not in documents.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.tables import table
from marquee.session import written

# Fixed values of the contract: terms, and the numbers of the score.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
UNIT = 1_000_000_000
_LIMIT = UNIT // 1000  # what the frequency of a term can add at most

SPREAD = 8
BATCH = 1_000  # queries sent to the tasks at once
_PIECE = 1 << 20  # bytes of a text taken apart at once
_DOCS = 256  # documents whose bounds are computed at once
_FULL = 255  # in a sketch: this often or more

INDEX = "row bigint, doc_id {kind}, n bigint, terms binary, times binary, sketch binary"


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about a megabyte, cut where no term is."""
    at = 0
    while len(text) - at > _PIECE:
        end = TERM.match(text, at + _PIECE)
        stop = end.end() if end else at + _PIECE
        yield text[at:stop]
        at = stop
    yield text[at:] if at else text


def counted(text: str | bytes) -> Counter:
    """How often each term occurs. Bytes are put in lower case, which is A-Z alone."""
    found = Counter()
    for piece in pieces(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text):
        found.update(TERM.findall(piece.lower()))
    return found


def width(distinct: int) -> int:
    """Coordinates of a sketch: a power of two."""
    return 1 << max(6, (SPREAD * distinct - 1).bit_length())


def places(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms), np.uint32, len(terms))


def sketch(terms: list[bytes], times: np.ndarray) -> np.ndarray:
    """Maximum frequency at every coordinate."""
    out = np.zeros(width(len(terms)), np.uint8)
    np.maximum.at(out, places(terms) & np.uint32(len(out) - 1), np.minimum(times, _FULL).astype(np.uint8))
    return out


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``, written: row, doc_id, n (terms with repeats), terms
    (distinct, joined by blanks), times (32-bit frequencies), sketch. A null or empty text
    has no terms."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs[doc_id].alias("doc_id"),
        F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary").alias("text"),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _DOCS):
                part = batch.slice(start, _DOCS)
                made = {"n": [], "terms": [], "times": [], "sketch": []}
                for text in part.column(2):
                    found = counted(text.as_py())
                    terms = list(found)
                    times = np.fromiter(found.values(), np.uint32, len(terms))
                    made["n"].append(int(times.sum(dtype=np.int64)))
                    made["terms"].append(b" ".join(terms))
                    made["times"].append(times.tobytes())
                    made["sketch"].append(sketch(terms, times).tobytes())
                columns = [pa.array(made["n"], pa.int64()), *[pa.array(made[c], pa.binary()) for c in ("terms", "times", "sketch")]]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["row", "doc_id", *made])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(build, INDEX.format(kind=kind)), "lexical-index")


class Queries:
    """A batch of queries: their terms numbered, and each query's terms and weights in a row."""

    def __init__(self, items: list[tuple[int, str]]):
        counts = [(number, counted(text or "")) for number, text in items]
        counts = [(number, found) for number, found in counts if found]
        self.numbers = [number for number, _ in counts]
        self.terms = sorted({term for _, found in counts for term in found})
        self.place = {term: i for i, term in enumerate(self.terms)}
        self.hashes = places(self.terms)
        self.starts = np.cumsum([0] + [len(found) for _, found in counts])[:-1]
        self.columns = np.array([self.place[t] for _, found in counts for t in found], np.int64)
        self.repeats = np.array([n for _, found in counts for n in found.values()], np.int64)
        self.ends = np.append(self.starts[1:], len(self.columns))

    def weigh(self, docs: int, tokens: int, frequency: dict[int, int]) -> None:
        """Sets the corpus' numbers; ``frequency``: documents with term number i."""
        self.docs, self.tokens = docs, tokens
        weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * frequency.get(i, 0) + 1))) for i in range(len(self.terms))]
        self.weights = np.array(weights, np.int64)[self.columns] * self.repeats

    def measure(self, n: int) -> int:
        """What a document's length counts in its scores."""
        return 100 - 75 + (75 * n * self.docs) // self.tokens

    def scores(self, times: np.ndarray, measures: np.ndarray) -> np.ndarray:
        """Scores of documents (rows) for all queries; ``times``: frequencies of the terms."""
        per_term = UNIT * times // np.maximum(1000 * times + 8 * measures[:, None], 1)
        return np.add.reduceat(per_term[:, self.columns] * self.weights, self.starts, axis=1)

    def bounds(self, sketches: list[np.ndarray], measures: np.ndarray) -> np.ndarray:
        """Never below ``scores``."""
        times = np.stack([s[self.hashes & np.uint32(len(s) - 1)] for s in sketches]).astype(np.int64)
        per_term = UNIT * times // np.maximum(1000 * times + 8 * measures[:, None], 1)
        per_term[times == _FULL] = _LIMIT
        return np.add.reduceat(per_term[:, self.columns] * self.weights, self.starts, axis=1)


class Document:
    """The exact frequencies of a batch's terms in one document, looked up when first asked."""

    def __init__(self, terms: pa.Scalar, times: pa.Scalar, measure: int):
        self.terms, self.times, self.measure = terms, times, measure
        self.found = None

    def score(self, queries: Queries, query: int) -> int:
        if self.found is None:
            times = np.frombuffer(self.times.as_buffer(), np.uint32)
            self.found = np.zeros(len(queries.terms), np.int64)
            for i, term in enumerate(self.terms.as_py().split(b" ")):
                if (place := queries.place.get(term)) is not None:
                    self.found[place] = times[i]
        own = slice(queries.starts[query], queries.ends[query])
        times = self.found[queries.columns[own]]
        return int((queries.weights[own] * (UNIT * times // (1000 * times + 8 * self.measure))).sum())


class Best:
    """The k best rows of every query so far: score, then smallest identifier (a missing one
    last), then row."""

    def __init__(self, queries: Queries, k: int):
        self.queries, self.k = queries, k
        self.heaps = [[] for _ in queries.numbers]
        self.floors = np.ones(len(self.heaps), np.int64)  # a score below it is not among the best

    def add(self, query: int, score: int, order: tuple, entry: tuple) -> None:
        heap = self.heaps[query]
        item = (score, _Last(order), entry)
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        else:
            heapq.heappushpop(heap, item)
        if len(heap) == self.k:
            self.floors[query] = heap[0][0]

    def take(self, docs: list[tuple], bounds: np.ndarray) -> None:
        """Scores documents (row, doc_id, Document) from the highest bound down, for each
        query until a bound is below its floor."""
        reach = bounds >= self.floors
        for query in np.flatnonzero(reach.any(axis=0)):
            own = np.flatnonzero(reach[:, query])
            for at in own[np.argsort(-bounds[own, query], kind="stable")]:
                if bounds[at, query] < self.floors[query]:
                    break
                row, doc_id, document = docs[at]
                score = document.score(self.queries, query)
                if score >= self.floors[query]:
                    self.add(query, score, (doc_id is None, 0 if doc_id is None else doc_id, row), (row, doc_id))

    def rows(self) -> Iterator[tuple]:
        for query, heap in enumerate(self.heaps):
            for score, _, (row, doc_id) in heap:
                yield self.queries.numbers[query], row, doc_id, score


class _Last:
    """Turns the order around: in a heap the largest comes first."""

    __slots__ = ("order",)

    def __init__(self, order: tuple):
        self.order = order

    def __lt__(self, other: _Last) -> bool:
        return self.order > other.order


def _frequencies(index: DataFrame, queries: Queries) -> dict[int, int]:
    """Number of documents with each term of the batch: at most one entry per term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, found = queries.place.keys(), Counter()
        for batch in batches:
            for terms in batch.column(0):
                found.update(wanted & set(terms.as_py().split(b" ")))
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array([queries.place[t] for t in found], pa.int64()), "n": pa.array(list(found.values()), pa.int64())}
        )

    counts = index.select("terms").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in counts.collect()}


def _best(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    """Every task's k best: query, row, doc_id, score."""
    kind = index.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, schema = Best(queries, k), None
        for batch in batches:
            schema = schema or pa.schema([("query", pa.int64()), ("row", pa.int64()), ("doc_id", batch.schema.field("doc_id").type), ("score", pa.int64())])
            for start in range(0, batch.num_rows, _DOCS):
                rows, ids, lengths, terms, times, sketches = batch.slice(start, _DOCS).columns
                measures = np.array([queries.measure(n) for n in lengths.to_pylist()], np.int64)
                bounds = queries.bounds([np.frombuffer(s.as_buffer(), np.uint8) for s in sketches], measures)
                docs = [(r, i, Document(t, c, m)) for r, i, t, c, m in zip(rows.to_pylist(), ids.to_pylist(), terms, times, measures.tolist(), strict=True)]
                best.take(docs, bounds)
        if schema is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in best.rows()], schema=schema)

    return index.select("row", "doc_id", "n", "terms", "times", "sketch").mapInArrow(scan, f"query bigint, row bigint, doc_id {kind}, score bigint")


def _top(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _batches(queries: DataFrame, batch: int) -> tuple[DataFrame, int]:
    """``queries`` with a number for every row and the batch it is in, written; batches hold
    ``batch`` rows on average."""
    numbered = written(
        queries.select("*", F.monotonically_increasing_id().alias("__query")), "queries"
    )
    n = max(1, -(-numbered.count() // batch))
    return numbered.withColumn("__batch", F.pmod(F.xxhash64("__query"), F.lit(n))), n


def search(index: DataFrame, queries: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 10, batch: int = BATCH) -> DataFrame:
    """item_id, rank, doc_id, score: for every row of ``queries`` the ``k`` rows of ``index``
    with the highest scores above 0, all if there are fewer.

    Equal scores are in the order of their identifiers, a missing one last; documents that
    repeat an identifier are documents of their own, as are queries. A query without terms,
    or none of whose terms is in the corpus, has no result. An empty index or an empty table
    of queries gives no rows.
    """
    spark = index.sparkSession
    kinds = queries.schema[item_id].dataType.simpleString(), index.schema["doc_id"].dataType.simpleString()
    corpus = index.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens")).first()
    numbered, n = _batches(queries.select(queries[item_id].alias("item_id"), queries[text].cast("string").alias("text")), batch)
    found = spark.createDataFrame([], f"query bigint, row bigint, doc_id {kinds[1]}, score bigint, rank int")
    for number in range(n if corpus.docs else 0):
        items = numbered.where(F.col("__batch") == number).select("__query", "text").collect()
        asked = Queries([(r[0], r[1]) for r in sorted(items)])
        if not asked.numbers:
            continue
        asked.weigh(corpus.docs, corpus.tokens, _frequencies(index, asked))
        found = found.unionByName(written(_top(_best(index, asked, k), k), "ranked"))
    named = numbered.select(F.col("__query").alias("query"), "item_id")
    return found.join(named, "query").select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    return search(index, table(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_TERMS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLE = f"""
WITH tokens AS (
    SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS terms FROM documents
), docs AS (
    SELECT *, len(terms) AS n FROM tokens WHERE len(terms) > 0
), corpus AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS tokens FROM docs
), times AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term
), items AS (
    SELECT row_number() OVER () AS q, item_id, {_SQL_TERMS} AS terms FROM benchmark
), asked AS (
    SELECT q, term, count(*) AS repeats FROM (SELECT q, unnest(terms) AS term FROM items) GROUP BY q, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM times CROSS JOIN corpus GROUP BY term, docs
), scores AS (
    SELECT q, r, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // tokens))))::BIGINT AS score
    FROM asked JOIN times USING (term) JOIN weights USING (term) JOIN docs USING (r), corpus
    GROUP BY q, r
), ranked AS (
    SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank
    FROM scores JOIN docs USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= 10
"""
