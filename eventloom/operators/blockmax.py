"""Block-max search: BM25 top-k that completes few of the (event, page) scores.

The index is a table of page blocks. Pages are ordered by their most frequent word
(which keeps a language together) and cut into blocks; a row holds a block's pages
and its postings by term, so the largest weight of a term in a block is at hand.
All contributions are positive, so sums of largest weights bound scores from above:

* a block whose bound stays below an event's k-th best score so far is skipped;
* in the others, totals of all pages are formed for many events at a time in single precision: words
  that many pages hold by one matrix product, the others by their postings;
* at the end of a group, the pages whose total may reach the k-th best score so far, by the bound of what
  single precision rounds off, are scored again in double precision. Few are left.

The k-th best score so far starts from the index: a term's k-th largest weight within
one block is the score of at least k pages. Events and blocks are packed into rows of bounded
size, chunks of events and groups of blocks, which meet in a cartesian product: a task holds a
chunk and reads the groups one after the other from the written index. So neither side is
written once more per cell of a grid, nothing is collected or broadcast, and an event's k-th
best score so far goes on from group to group.

``score_blocks`` is the plain form: postings dealt by page meet chunks of query words the same way,
words are joined and scores summed in double precision where they meet, and every pair with a common word is scored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import words
from eventloom.sources.tables import discard, staged

BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DECIMALS = 6
SLACK = 2e-6  # scores are ranked rounded to six decimals
BLOCK_PAGES = 512  # pages of an index row
GROUP_BLOCKS = 16  # index rows of a packed group
GROUP_BYTES = 32 << 20  # a group or chunk of this size is closed
CHUNK_EVENTS = 16384  # events of a packed chunk
DENSE_PAGES = 128  # a word of so many pages of a block has a weight for each page
ROUNDING = 2.0**-23  # twice what single precision rounds off
TINY = 1e-30  # no weight is as small
CUT_POSTINGS = 1 << 18  # postings that are cut into blocks at a time
TILE_EVENTS = 512  # events of a product
TILE_CELLS = 1 << 20  # words looked up at a time
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def page_blocks(corpus: DataFrame, id_col: str, text_col: str, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """The index: ``(page_ids, dl, terms, starts, pages, tf)``, one row per block of pages, written.

    Posting ``j`` of term ``i`` (``starts[i] <= j < starts[i + 1]``) says how often page
    ``pages[j]`` of the block holds it; ``dl`` are the pages' lengths in words.
    """
    kind = corpus.schema[id_col].dataType.simpleString()
    pages = corpus.select(F.col(id_col).alias("page_id"), words(F.lower(F.col(text_col))).alias("toks"))

    def count(batches):
        for batch in batches:
            toks = batch.column(1)
            toks = toks.fill_null([]) if toks.null_count else toks
            dl = toks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
            coded = pc.dictionary_encode(toks.flatten())
            size = max(len(coded.dictionary), 1)
            page = np.repeat(np.arange(len(dl), dtype=np.int64), dl)
            pair, tf = np.unique(page * size + coded.indices.to_numpy(), return_counts=True)
            page, term = pair // size, pair % size
            first = np.searchsorted(page, np.arange(len(dl) + 1)).astype(np.int32)
            # The page's most frequent word, the first in order among equals.
            names = coded.dictionary.take(pa.array(term))
            rank = pc.rank(coded.dictionary, tiebreaker="first").to_numpy()[term] if len(term) else term
            order = np.lexsort((rank, -tf, page))
            lead = pa.array([names[int(order[a])].as_py() if b > a else "" for a, b in zip(first[:-1], first[1:])], pa.string())
            lists = [pa.ListArray.from_arrays(pa.array(first), x) for x in (names, pa.array(tf.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dl), lead, *lists], ["page_id", "dl", "lead", "terms", "tf"])

    counted = staged(pages.mapInArrow(count, f"page_id {kind}, dl int, lead string, terms array<string>, tf array<int>"), "page-terms")
    parts = max(1, math.ceil(counted.count() / block_pages))
    ordered = counted.repartitionByRange(parts, "lead", "page_id").sortWithinPartitions("lead", "page_id")

    def index(batches):
        held, n = [], 0

        def cut():
            table = pa.Table.from_batches(held).combine_chunks()
            for first in range(0, table.num_rows, block_pages):
                part = table.slice(first, block_pages).combine_chunks()
                terms = part.column("terms").combine_chunks()
                coded = pc.dictionary_encode(terms.flatten())
                page = np.repeat(np.arange(part.num_rows, dtype=np.int32), terms.value_lengths().to_numpy(zero_copy_only=False))
                tf = part.column("tf").combine_chunks().flatten().to_numpy()
                code = coded.indices.to_numpy()
                order = np.lexsort((page, code))
                starts = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1)).astype(np.int32)
                row = [part.column("page_id").combine_chunks(), part.column("dl").combine_chunks(), coded.dictionary, pa.array(starts), pa.array(page[order]), pa.array(tf[order])]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in row]
                yield pa.RecordBatch.from_arrays(lists, ["page_ids", "dl", "terms", "starts", "pages", "tf"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 4 * block_pages:
                yield from cut()
                held, n = [], 0
        if held:
            yield from cut()

    schema = f"page_ids array<{kind}>, dl array<int>, terms array<string>, starts array<int>, pages array<int>, tf array<int>"
    blocks = staged(ordered.mapInArrow(index, schema).withColumn("block", F.monotonically_increasing_id()), "page-blocks")
    discard(counted)
    return blocks


def _column(table: pa.Table, name: str, row: int) -> np.ndarray:
    return table.column(name)[row].values.to_numpy(zero_copy_only=False)


def _weights(block: pa.Table, row: int, avgdl: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, pages, weights) of a block's postings; a weight times the term's idf is a contribution."""
    pages, tf = _column(block, "pages", row), _column(block, "tf", row).astype(float)
    norm = BM25_K1 * (1 - BM25_B + BM25_B * _column(block, "dl", row) / avgdl)
    return _column(block, "starts", row), pages, tf * (BM25_K1 + 1) / (tf + norm[pages])


def term_statistics(blocks: DataFrame, avgdl: float, k: int) -> DataFrame:
    """``(term, df, kth)``: pages that hold a term, and a weight that at least k of them reach (0: not known)."""

    def rows(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for row in range(table.num_rows):
                starts, _, weight = _weights(table, row, avgdl)
                df = np.diff(starts)
                term = np.repeat(np.arange(len(df)), df)
                ordered = weight[np.lexsort((-weight, term))]
                kth = np.zeros(len(df))
                enough = df >= k
                kth[enough] = ordered[starts[:-1][enough] + k - 1]
                yield pa.RecordBatch.from_arrays([table.column("terms")[row].values, pa.array(df.astype(np.int64)), pa.array(kth)], ["term", "df", "kth"])

    found = blocks.mapInArrow(rows, "term string, df long, kth double")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.max("kth").alias("kth"))


class _Block:
    """The postings of a page block opened by a task. Words that many of its pages hold have a row of weights for all pages."""

    def __init__(self, n: int, codes: np.ndarray, postings: tuple[np.ndarray, np.ndarray, np.ndarray]):
        starts, self.pages, self.weight = postings
        self.n, self.codes, self.starts = n, codes, starts.astype(np.int64)
        self.most = np.maximum.reduceat(self.weight, starts[:-1]) if len(codes) else np.zeros(0)
        self.df = np.diff(starts)
        self.frequent = np.where(self.df >= DENSE_PAGES, np.cumsum(self.df >= DENSE_PAGES) - 1, -1)
        self.light, self._dense, self._keys = self.weight.astype(np.float32), {}, None

    def find(self, codes: np.ndarray, size: int) -> np.ndarray:
        """The block's number of every word of the group (of ``size`` words), or -1."""
        place = np.full(size + 1, -1, np.int32)  # the last is for words that the group does not hold
        place[self.codes] = np.arange(len(self.codes), dtype=np.int32)
        return place[codes]

    def dense(self, kind) -> np.ndarray:
        if kind not in self._dense:
            rows = np.zeros((int((self.df >= DENSE_PAGES).sum()), self.n), kind)
            owner, keep = np.repeat(np.arange(len(self.df)), self.df), np.repeat(self.df >= DENSE_PAGES, self.df)
            rows[self.frequent[owner[keep]], self.pages[keep]] = self.weight[keep]
            self._dense[kind] = rows
        return self._dense[kind]

    def totals(self, n_events: int, event: np.ndarray, terms: np.ndarray, idf: np.ndarray, kind=np.float64) -> np.ndarray:
        """The events' totals of all pages, from every (event, term): one product for the frequent words, postings for the others."""
        row = self.frequent[terms]
        often = row >= 0
        if often.any():
            dense = self.dense(kind)
            left = np.zeros((n_events, len(dense)), kind)
            left[event[often], row[often]] = idf[often]
            total = left @ dense
        else:
            total = np.zeros((n_events, self.n), kind)
        event, terms, idf = event[~often], terms[~often], idf[~often].astype(kind)
        if len(terms):
            first, n = self.starts[terms], self.df[terms]
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            weight = self.light if kind == np.float32 else self.weight
            np.add.at(total.reshape(-1), np.repeat(event * self.n, n) + self.pages[at], weight[at] * np.repeat(idf, n))
        return total

    def exact(self, events: _Events, at: np.ndarray, event: np.ndarray, page: np.ndarray) -> np.ndarray:
        """The scores of (event, page), summed in double precision in the order of the event's words."""
        if self._keys is None:
            self._keys = np.repeat(np.arange(len(self.df), dtype=np.int64) * self.n, self.df) + self.pages
        score, size = np.zeros(len(event)), events.size[event]
        cuts = np.searchsorted(np.cumsum(size), np.arange(TILE_CELLS, size.sum() + TILE_CELLS, TILE_CELLS))
        for a, b in zip(np.append(0, cuts[:-1]), cuts):
            n = size[a:b]
            entry = np.repeat(events.starts[event[a:b]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            term, pair = at[entry], np.repeat(np.arange(a, b), n)
            known = term >= 0
            entry, pair, key = entry[known], pair[known], term[known].astype(np.int64) * self.n + page[pair[known]]
            place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            held = self._keys[place] == key
            score[a:b] = np.bincount(pair[held] - a, self.weight[place[held]] * events.idf[entry[held]], minlength=b - a)
        return score


class _Group:
    """A group of page blocks opened by a task, with one vocabulary."""

    def __init__(self, table: pa.Table, postings):
        """``postings(table, row)`` gives a block's ``(starts, pages, weights)``."""
        words_ = pc.dictionary_encode(table.column("terms").combine_chunks().flatten())
        self.words, codes = words_.dictionary, words_.indices.to_numpy()
        ends = np.cumsum(table.column("terms").combine_chunks().value_lengths().to_numpy(zero_copy_only=False))
        sizes = table.column("page_ids").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        self.blocks = [_Block(int(sizes[row]), codes[first:end], postings(table, row)) for row, (first, end) in enumerate(zip(np.append(0, ends[:-1]), ends))]
        self.ids, self.base = table.column("page_ids").combine_chunks().flatten(), np.append(0, np.cumsum(sizes))
        self.by_id = pc.rank(self.ids, null_placement="at_start", tiebreaker="first").to_numpy().astype(np.int64)

    def find(self, events: _Events) -> np.ndarray:
        """The group's code of every word of the events, one past the last for a word that it does not hold."""
        if not len(events.names) or not len(self.words):
            return np.full(len(events.codes), len(self.words))
        found = pc.index_in(events.names, value_set=self.words)
        return found.fill_null(len(self.words)).to_numpy()[events.codes]


class _Events:
    """A chunk of events opened by a task: their words, and their ``k`` best scores in the groups so far."""

    def __init__(self, table: pa.Table, k: int | None):
        lists = table.column("terms").combine_chunks()
        self.ids, self.k = table.column("event_id").combine_chunks(), k
        self.size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.size) - self.size
        self.owner = np.repeat(np.arange(len(self.size)), self.size)
        coded = pc.dictionary_encode(lists.flatten())  # a word is looked up once in a group
        self.names, self.codes = coded.dictionary, coded.indices.to_numpy()
        self.idf = table.column("idf").combine_chunks().flatten().to_numpy()
        self.floor = table.column("floor").to_numpy() if "floor" in table.column_names else np.zeros(len(self.size))
        self.best = None if k is None else np.full((len(self.size), k), -np.inf)


def _raised(best: np.ndarray, event: np.ndarray, score: np.ndarray) -> None:
    """Bring scores of events, which come in order of event and falling score, into the events' ``k`` best."""
    k = best.shape[1]
    place = np.arange(len(event)) - np.searchsorted(event, event)
    event, score, place = event[place < k], score[place < k], place[place < k]
    rows, at = np.unique(event, return_inverse=True)
    here = np.full((len(rows), k), -np.inf)
    here[at, place] = score
    best[rows] = np.sort(np.concatenate([best[rows], here], axis=1), axis=1)[:, -k:]


def _reaching(total: np.ndarray, cut: np.ndarray, k: int, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(events, pages, totals) that are positive and reach the event's ``cut``; where many do, all within ``near`` of its k-th best."""
    least = np.maximum(cut, TINY).astype(total.dtype)
    cell = np.flatnonzero(total >= least[:, None])
    event = cell // total.shape[1]
    many = np.flatnonzero(np.bincount(event, minlength=len(total)) > 2 * k)
    if len(many):
        kth = np.partition(total[many], total.shape[1] - k, axis=1)[:, total.shape[1] - k]
        least[many] = np.maximum(least[many], (kth - near[many]).astype(total.dtype))
        cell = cell[total.reshape(-1)[cell] >= least[event]]
        event = cell // total.shape[1]
    return event, cell - event * total.shape[1], total.reshape(-1)[cell].astype(np.float64)


def _k_best(group: _Group, events: _Events, event: np.ndarray, page: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An event's ``k`` best of the group by (rounded score, id), as far as they reach its best of all groups so far."""
    order = np.lexsort((group.by_id[page], -np.round(score, SCORE_DECIMALS), event))
    event, page, score = event[order], page[order], score[order]
    place = np.arange(len(event)) - np.searchsorted(event, event)
    event, page, score = event[place < events.k], page[place < events.k], score[place < events.k]
    order = np.lexsort((-score, event))
    _raised(events.best, event[order], score[order])
    reach = score >= events.best[event, 0] - SLACK
    return event[reach], page[reach], score[reach]


def search_cell(events: _Events, group: _Group) -> pa.Table:
    """``(event_id, page_id, score, scored)``: the k best pages of a group for each event of a chunk.

    Pages that do not reach the k best of the groups before are left out. ``scored`` is, on an event's
    first row, how many pages were scored in double precision for it.
    """
    n_events, k = len(events.size), events.k
    codes = group.find(events)
    at = [block.find(codes, len(group.words)) for block in group.blocks]
    bounds = np.zeros((len(at), n_events))
    for b, block in enumerate(group.blocks):
        known = np.flatnonzero(at[b] >= 0)
        bounds[b] = np.bincount(events.owner[known], events.idf[known] * block.most[at[b][known]], minlength=n_events)
    floor, low = np.maximum(events.floor, events.best[:, 0]), events.best.copy()
    promising = bounds.argmax(axis=0)
    found = []
    for ahead in (True, False):  # every event's most promising block raises its floor first
        for b, block in enumerate(group.blocks):
            wanted = (bounds[b] > 0) & (bounds[b] >= floor - SLACK) & ((promising == b) == ahead)
            chosen = np.flatnonzero(wanted)
            mine = np.flatnonzero((at[b] >= 0) & wanted[events.owner])
            event, terms, idf = (np.cumsum(wanted) - 1)[events.owner[mine]], at[b][mine], events.idf[mine]
            off = ROUNDING * (events.size[chosen] + 8) * bounds[b][chosen]  # how far a total in single precision may lie off
            for first in range(0, len(chosen), TILE_EVENTS):
                some, slack = chosen[first : first + TILE_EVENTS], off[first : first + TILE_EVENTS]
                x, y = np.searchsorted(event, [first, first + TILE_EVENTS])
                total = block.totals(len(some), event[x:y] - first, terms[x:y], idf[x:y], np.float32)
                i, page, score = _reaching(total, floor[some] - slack - SLACK, k, 2 * slack + SLACK)
                if len(i):
                    found.append((some[i], np.full(len(i), b), page, score + slack[i]))
                    order = np.lexsort((-score, i))
                    _raised(low, some[i[order]], (score - slack[i])[order])
                    floor[some] = np.maximum(floor[some], low[some, 0])
    event, at_block, page, most = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
    left = most >= floor[event] - SLACK
    event, at_block, page = event[left], at_block[left], page[left]
    score = np.zeros(len(event))
    for b, block in enumerate(group.blocks):
        here = np.flatnonzero(at_block == b)
        if len(here):
            score[here] = block.exact(events, at[b], event[here], page[here])
    scored = np.bincount(event, minlength=n_events)
    event, page, score = _k_best(group, events, event, group.base[at_block] + page, score)
    head = np.where(np.arange(len(event)) == np.searchsorted(event, event), scored[event], 0)
    return pa.table({
        "event_id": events.ids.take(pa.array(event)),
        "page_id": group.ids.take(pa.array(page)),
        "score": pa.array(score, pa.float64()),
        "scored": pa.array(head, pa.int64()),
    })


def packed_table(table: pa.Table) -> bytes:
    """A table as an Arrow file, to be a value of a row."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _packed(df: DataFrame, most_rows: int, name: str) -> DataFrame:
    """``(<name>, <name>_rows)``: a partition's rows in Arrow files of at most ``most_rows`` rows and about ``GROUP_BYTES``."""

    def rows(batches):
        from pyspark import TaskContext

        number, held, n, size = TaskContext.get().partitionId() << 32, [], 0, 0

        def cut():
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed_table(pa.Table.from_batches(held))], pa.binary())], [name, f"{name}_rows"])

        step = 64 if most_rows >= 64 else 1
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                held.append(batch.slice(at, step))
                n, size = n + held[-1].num_rows, size + held[-1].nbytes
                if n >= most_rows or size >= GROUP_BYTES:
                    yield cut()
                    number, held, n, size = number + 1, [], 0, 0
        if held:
            yield cut()

    return df.mapInArrow(rows, f"{name} long, {name}_rows binary")


def unpacked_table(value) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all().combine_chunks()


def search_blocks(events: DataFrame, blocks: DataFrame, k: int, avgdl: float, n_events: int, n_blocks: int, page_kind: str) -> DataFrame:
    """``search_cell`` over all chunks of events ``(event_id, terms, idf, floor)`` and all groups of page blocks, written."""
    events = events.select("event_id", "terms", "idf", "floor")
    blocks = blocks.select("page_ids", "dl", "terms", "starts", "pages", "tf").coalesce(max(1, math.ceil(n_blocks / GROUP_BLOCKS)))
    return _meet_blocks(events, blocks, search_cell, lambda table, row: _weights(table, row, avgdl), k, n_events, page_kind, ", scored long")


def _meet_blocks(events: DataFrame, blocks: DataFrame, cell, postings, k: int | None, n_events: int, page_kind: str, extra: str = "") -> DataFrame:
    """``cell(events, group)`` over all chunks of events and all groups of page blocks, written."""
    spark = events.sparkSession
    parallelism = spark.sparkContext.defaultParallelism
    # A small input: smaller chunks, so that every core gets one.
    down = max(1, math.ceil(n_events / CHUNK_EVENTS), min(n_events // 64, 2 * parallelism))
    chunks = staged(_packed(events.repartition(down, "event_id"), CHUNK_EVENTS, "chunk"), "query-chunks")
    groups = staged(_packed(blocks, GROUP_BLOCKS, "blocks"), "page-block-groups")
    event_kind = events.schema["event_id"].dataType.simpleString()

    def meet(batches):
        opened, at, group = {}, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                number, chunk = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                if number != at:  # the chunks of a partition follow each other
                    at, group = number, _Group(unpacked_table(batch.column(1)[i]), postings)
                if chunk not in opened:
                    opened[chunk] = _Events(unpacked_table(batch.column(3)[i]), k)
                yield from cell(opened[chunk], group).to_batches()

    # The right side of the product is held (a few chunks), the left one is read row by row. One partition
    # of groups if there are chunks enough: what is found in one group prunes the next.
    pairs = groups.coalesce(math.ceil(parallelism / down)).hint("shuffle_replicate_nl").crossJoin(chunks)
    found = pairs.mapInArrow(meet, f"event_id {event_kind}, page_id {page_kind}, score double{extra}")
    kept = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, "1")  # a row is a whole chunk and a whole group
    try:
        return staged(found, "search-found")
    finally:
        spark.conf.set(ARROW_ROWS, kept)
        discard(chunks)
        discard(groups)


def posting_blocks(postings: DataFrame, n_pages: int, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """``(page_id, term, weight)`` dealt by page: ``(page_ids, terms, starts, pages, weight)``, a row per block of whole pages.

    Weights of one page and term are added up, so rows that share a page id are one page.
    """
    kind = postings.schema["page_id"].dataType.simpleString()
    parallelism = postings.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(n_pages / (block_pages * GROUP_BLOCKS)), min(n_pages // block_pages, parallelism))
    dealt = postings.repartition(parts, "page_id").groupBy("page_id", "term").agg(F.sum("weight").alias("weight"))

    def rows(batches):
        held, n = [], 0

        def cut(last: bool):
            """Rows of whole pages; with the pages that may go on they are held."""
            table = pa.Table.from_batches(held).combine_chunks()
            coded = pc.dictionary_encode(table.column("page_id").combine_chunks(), null_encoding="encode")
            page = coded.indices.to_numpy()  # numbered as they come, so in order
            stop = len(coded.dictionary) if last else page[-1] // block_pages * block_pages
            out = []
            for first in range(0, stop, block_pages):
                a, b = np.searchsorted(page, [first, min(first + block_pages, stop)])
                terms = pc.dictionary_encode(table.column("term").slice(a, b - a).combine_chunks())
                code = terms.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                starts = np.searchsorted(code[order], np.arange(len(terms.dictionary) + 1)).astype(np.int32)
                weight = table.column("weight").slice(a, b - a).to_numpy()[order]
                row = [coded.dictionary.slice(first, min(block_pages, stop - first)), terms.dictionary, pa.array(starts), pa.array((page[a:b] - first)[order].astype(np.int32)), pa.array(weight)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in row]
                out.append(pa.RecordBatch.from_arrays(lists, ["page_ids", "terms", "starts", "pages", "weight"]))
            rest = table.slice(np.searchsorted(page, stop))
            return out, rest.to_batches(), rest.num_rows

        wanted = CUT_POSTINGS
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= wanted:
                out, held, n = cut(False)
                yield from out
                wanted = n + CUT_POSTINGS
        if n:
            yield from cut(True)[0]

    schema = f"page_ids array<{kind}>, terms array<string>, starts array<int>, pages array<int>, weight array<double>"
    return dealt.select("page_id", "term", "weight").sortWithinPartitions("page_id").mapInArrow(rows, schema)


def score_cell(events: _Events, group: _Group) -> pa.Table:
    """``(event_id, page_id, score)`` of every event and page of a cell with a common word, no bound rules one out,
    or of each event's ``k`` best pages."""
    codes, found = group.find(events), []
    for block, base in zip(group.blocks, group.base):
        at = block.find(codes, len(group.words))
        mine = np.flatnonzero(at >= 0)
        event, terms, idf = events.owner[mine], at[mine], events.idf[mine]
        for first in range(0, len(events.size), TILE_EVENTS):
            a, b = np.searchsorted(event, [first, first + TILE_EVENTS])
            if a == b:
                continue
            n = min(TILE_EVENTS, len(events.size) - first)
            total = block.totals(n, event[a:b] - first, terms[a:b], idf[a:b])
            if events.k is None:
                i, page = np.nonzero(total > 0)
                score = total[i, page]
            else:
                i, page, score = _reaching(total, events.best[first : first + n, 0] - SLACK, events.k, np.full(n, SLACK))
                order = np.lexsort((group.by_id[base + page], -np.round(score, SCORE_DECIMALS), i))
                i, page, score = i[order], page[order], score[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < events.k
                i, page, score = i[keep], page[keep], score[keep]
                order = np.lexsort((-score, i))
                _raised(events.best, first + i[order], score[order])
            found.append((first + i, base + page, score))
    event, page, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    if events.k is not None:
        reach = score >= events.best[event, 0] - SLACK
        event, page, score = event[reach], page[reach], score[reach]
    return pa.table({
        "event_id": events.ids.take(pa.array(event)),
        "page_id": group.ids.take(pa.array(page)),
        "score": pa.array(score, pa.float64()),
    })


def score_blocks(events: DataFrame, blocks: DataFrame, k: int | None, n_events: int, page_kind: str) -> DataFrame:
    """``score_cell`` over all chunks of events ``(event_id, terms, idf)`` and all groups of ``posting_blocks``, written."""
    return _meet_blocks(events.select("event_id", "terms", "idf"), blocks, score_cell, _given_weights, k, n_events, page_kind)


def _given_weights(table: pa.Table, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(_column(table, c, row) for c in ("starts", "pages", "weight"))
