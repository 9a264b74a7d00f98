"""Ranked lexical search of many queries at once, with shared partial scores.

A document's score for a query is a sum over the query's terms, so queries that share
terms share parts of their sums. Queries are mined for such parts: the pair of terms, or
of parts found before, that most queries hold together becomes a node of its own, again
and again, until no pair is held twice. What is left is an acyclic graph in which terms
feed shared nodes and these feed queries. For each batch of documents every node is one
row of partial scores, summed once from the rows of its children, whatever number of
queries reads it; queries add their few remaining rows.

Documents are read twice. The first pass finds the terms of any query in whole texts and
stores, for each document, its length and the terms it holds; document frequencies are
summed in each task before they travel. The second pass reads this table, evaluates the
graph, and keeps in each task the ``TOP`` best of every query seen there; one ranking of these
rows ends it. Queries are worked on in blocks of about ``BLOCK_TERMS`` terms, so that what
is sent to executors is of bounded size: one graph and one vocabulary. Mining looks at the
``WIDTH`` most shared terms of a query; a longer one adds its others one by one. Terms are
told apart by hashes of 64 bits.

Cases: null and empty texts have no terms; as documents they aren't counted and found by
nothing, as queries they have no rows. Documents without an id come last among equal
scores, and their id is null. Rows that repeat an id are documents or queries of their own.
An empty table of either kind gives no rows. Other columns of the input are left out.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotterflow.llm.batches import TEXT, pieces
from blotterflow.llm.tables import discard, stored
from blotterflow.llm.words import ALNUM, FOLD, split_words

TOP = 20
BLOCK_TERMS, WIDTH = 1 << 17, 64
#: Partial scores held at once in a task.
CELLS = 1 << 21
NO_ID = (1 << 63) - 1

TERMS = "item long, term long, times int"
HITS = "counted boolean, id long, n long, terms array<int>, times array<long>"
GRAPH = "block int, node int, item long, children array<int>"


def _term_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, term hash and count of the terms of each text, and all words of each text."""
    words = split_words(column, ALNUM, FOLD)
    hashes, text = words.hashes(), words.text_of()
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at].view(np.int64), np.diff(np.append(at, len(text))), words.counts


def _item_terms(batches):
    for batch in batches:
        for piece in pieces(batch, TEXT):
            text, term, times, _ = _term_counts(piece.column(TEXT))
            item = piece.column("item").to_numpy()[text]
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(term), pa.array(times.astype(np.int32))], names=["item", "term", "times"])


def mine(queries: Sequence[Sequence[int]], symbols: int, width: int = WIDTH) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Shared nodes and what each query is the sum of.

    ``queries`` are sets of numbers below ``symbols``; node i of the result has the number
    ``symbols`` + i and is the sum of two earlier numbers.
    """
    held = Counter(s for q in queries for s in q)
    own = []
    where: dict[int, set[int]] = {}
    for i, q in enumerate(queries):
        shared = sorted((s for s in q if held[s] > 1), key=lambda s: (-held[s], s))[:width]
        own.append(set(shared))
        for s in shared:
            where.setdefault(s, set()).add(i)
    loose = [[s for s in q if s not in own[i]] for i, q in enumerate(queries)]
    pairs = Counter((a, b) for mine_ in own for a in mine_ for b in mine_ if a < b)
    heap = [(-n, a, b) for (a, b), n in pairs.items() if n > 1]
    heapq.heapify(heap)
    nodes: list[tuple[int, int]] = []
    while heap:
        n, a, b = heapq.heappop(heap)
        both = where[a] & where[b]
        if len(both) != -n:  # some of them have used it elsewhere since
            if len(both) > 1:
                heapq.heappush(heap, (-len(both), a, b))
            continue
        node = symbols + len(nodes)
        nodes.append((a, b))
        where[a] -= both
        where[b] -= both
        where[node] = both
        beside = Counter()
        for i in both:
            own[i] -= {a, b}
            beside.update(own[i])
            own[i].add(node)
        for s, n in beside.items():
            if n > 1:
                heapq.heappush(heap, (-n, s, node))
    return nodes, [loose[i] + sorted(own[i]) for i in range(len(queries))]


def _graph(table: pa.Table) -> pa.Table:
    """The graph of one block: rows of nodes, whose children are terms by rank or other nodes, and of queries."""
    table = table.sort_by([("item", "ascending"), ("term", "ascending")])
    block = table.column("block")[0].as_py()
    vocabulary, term = np.unique(table.column("term").to_numpy(), return_inverse=True)
    times, item = table.column("times").to_numpy(), table.column("item").to_numpy()
    # the second, third... of a repeated term is a symbol of its own that reads the term's row
    symbol_of: dict[tuple[int, int], int] = {}
    queries: dict[int, list[int]] = {}
    for i, t, n in zip(item.tolist(), term.tolist(), times.tolist(), strict=True):
        queries.setdefault(i, []).extend(symbol_of.setdefault((t, k), len(symbol_of)) for k in range(n))
    row_of = [t for t, _ in symbol_of]
    base, size = len(row_of), len(vocabulary)
    nodes, sums = mine(list(queries.values()), base)
    row = lambda s: row_of[s] if s < base else size + s - base
    rows = [{"block": block, "node": size + k, "item": None, "children": [row(a), row(b)]} for k, (a, b) in enumerate(nodes)]
    rows += [{"block": block, "node": None, "item": i, "children": [row(s) for s in q]} for i, q in zip(queries, sums, strict=True)]
    kinds = [("block", pa.int32()), ("node", pa.int32()), ("item", pa.int64()), ("children", pa.list_(pa.int32()))]
    return pa.Table.from_pylist(rows, schema=pa.schema(kinds))


def _hits(sent):
    """Documents with the terms they hold, by rank in the vocabulary; at last how many documents of the task hold each."""

    def run(batches):
        vocabulary = sent.value
        frequency = np.zeros(len(vocabulary), np.int64)
        names = [c.split()[0] for c in HITS.split(", ")]

        def rows(counted, ids, n, starts, terms, times):
            lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (times, pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array([counted] * len(n), pa.bool_()), ids, pa.array(n, pa.int64()), *lists], names=names)

        for batch in batches:
            for piece in pieces(batch, TEXT):
                text, term, times, n = _term_counts(piece.column(TEXT))
                rank = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
                known = vocabulary[rank] == term
                text, rank, times = text[known], rank[known], times[known]
                frequency += np.bincount(rank, minlength=len(vocabulary))
                yield rows(True, piece.column("id"), n, np.searchsorted(text, np.arange(len(n) + 1)), rank, times)
        some = np.flatnonzero(frequency)
        yield rows(False, pa.array([None], pa.int64()), [0], [0, len(some)], some, frequency[some])

    return run


@dataclass
class Plan:
    """A block's graph: term weights, sums by level, and the sums of its items."""

    weights: np.ndarray
    documents: int
    words: int
    rows: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    items: np.ndarray
    item_sums: tuple[np.ndarray, np.ndarray]

    @property
    def batch(self) -> int:
        """Documents evaluated at once."""
        widest = max([len(c) for _, c, _ in self.levels] + [len(self.item_sums[0])])
        return max(CELLS // (self.rows + widest + len(self.items)), 1)

    def parts(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        """What each term adds to the score of each document that holds it."""
        norm = 100 - 25 + (25 * n * self.documents) // self.words
        return self.weights[term] * ((1_000_000_000 * times) // (1000 * times + 12 * norm[doc]))

    def scores(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Scores by item and document."""
        partial = np.zeros((self.rows, len(n)), np.int64)
        partial[term, doc] = self.parts(n, doc, term, times)
        for nodes, children, starts in self.levels:
            partial[nodes] = np.add.reduceat(partial[children], starts, axis=0)
        children, starts = self.item_sums
        return np.add.reduceat(partial[children], starts, axis=0)


def _sums(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(c) for c in lists]
    return np.fromiter((c for x in lists for c in x), np.int64, sum(sizes)), np.cumsum([0, *sizes[:-1]])


def plan(graph: Sequence, weights: np.ndarray, documents: int, words: int) -> Plan:
    """``graph``: rows of ``GRAPH`` of one block."""
    size = len(weights)
    nodes = sorted((r.node, list(r.children)) for r in graph if r.node is not None)
    level = np.zeros(size + len(nodes), np.int64)
    for node, children in nodes:
        level[node] = 1 + max(level[c] for c in children)
    levels = []
    for depth in range(1, int(level.max(initial=0)) + 1):
        at = [(n, c) for n, c in nodes if level[n] == depth]
        levels.append((np.array([n for n, _ in at]), *_sums([c for _, c in at])))
    items = sorted((r.item, list(r.children)) for r in graph if r.node is None)
    return Plan(weights, documents, words, size + len(nodes), levels, np.array([i for i, _ in items]), _sums([c for _, c in items]))


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int):
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.bound = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.bound[:, None])
        if not len(item):
            return
        item, score, name = (np.concatenate(x) for x in ((self.item, item), (self.score, scores[item, doc]), (self.id, ids[doc])))
        order = np.lexsort((name, -score, item))
        item, score, name = item[order], score[order], name[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item, side="left")
        kept, last = rank < TOP, rank == TOP - 1
        self.item, self.score, self.id = item[kept], score[kept], name[kept]
        self.bound[item[last]] = score[last]


def _ranked(sent):
    def run(batches):
        graph: Plan = sent.value
        best = Best(len(graph.items))
        for batch in batches:
            ids = batch.column("id").fill_null(NO_ID).to_numpy()
            n = batch.column("n").to_numpy()
            lists = batch.column("terms"), batch.column("times")
            sizes = np.asarray(lists[0].value_lengths())
            ends = np.concatenate([[0], np.cumsum(sizes)])
            term, times = (np.asarray(x.flatten()).astype(np.int64) for x in lists)
            for low in range(0, len(n), graph.batch):
                high = min(low + graph.batch, len(n))
                part = slice(ends[low], ends[high])
                doc = np.repeat(np.arange(high - low), sizes[low:high])
                best.add(graph.scores(n[low:high], doc, term[part], times[part]), ids[low:high])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (graph.items[best.item], best.id, best.score)], names=["item", "id", "score"])

    return run


def _block(given: DataFrame, vocabulary: np.ndarray, graph: Sequence) -> DataFrame | None:
    """item, id, score of the best documents of one block, as the tasks found them."""
    spark = given.sparkSession
    hits = stored(given.mapInArrow(_hits(spark.sparkContext.broadcast(vocabulary)), HITS), "hits")
    total = hits.where("counted and n > 0").agg(F.count("*").alias("documents"), F.sum("n").alias("words")).first()
    if not total.documents:
        discard(hits)
        return None
    pairs = hits.where("not counted").select(F.explode(F.arrays_zip("terms", "times")).alias("p"))
    frequency = np.zeros(len(vocabulary), np.int64)
    for r in pairs.groupBy("p.terms").agg(F.sum("p.times").alias("n")).collect():
        frequency[r.terms] = r.n
    n = total.documents
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)
    sent = spark.sparkContext.broadcast(plan(graph, weights, n, total.words))
    out = stored(hits.where("counted").select("id", "n", "terms", "times").mapInArrow(_ranked(sent), "item long, id long, score long"), "ranked")
    discard(hits)
    return out


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_col, rank, id_col and score of the ``TOP`` best documents of each item."""
    spark = docs.sparkSession
    named = stored(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("named"), F.col(item_text_col).alias(TEXT)), "items")
    terms = stored(named.select("item", TEXT).mapInArrow(_item_terms, TERMS), "item-terms")
    blocks = -(-terms.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n")).first().n // BLOCK_TERMS)
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias(TEXT))
    found = None
    if blocks:
        dealt = terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
        graphs = stored(dealt.groupBy("block").applyInArrow(_graph, GRAPH), "graph")
        for b in range(blocks):
            own = dealt.where(F.col("block") == b).select("term").distinct().toArrow().column("term").to_numpy()
            part = _block(given, np.sort(own), graphs.where(F.col("block") == b).collect()) if len(own) else None
            if part is not None:
                found = part if found is None else found.unionByName(part)
        discard(graphs)
    if found is None:
        found = spark.createDataFrame([], "item long, id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return top.join(named.select("item", "named"), "item").select(
        F.col("named").alias(item_col), "rank", F.nullif("id", F.lit(NO_ID)).alias(id_col), "score"
    )
