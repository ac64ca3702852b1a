"""Packing of tokenized documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlore.llm.common import _SPACE, distinct, in_chunks, text_bytes, words_of

LENGTH = 4096  # most tokens of a sequence
END = 2  # the id that ends a document
BLOCK = 1 << 20  # tokens that are packed together
CHUNK = 1 << 22  # bytes of text that a task tokenizes at once
KNOWN = 300_000  # words whose ids a worker process keeps
STEP = 256  # inside a sentence of over LENGTH / 4 tokens, places to cut are so far apart

#: What a cut costs, in tokens of padding: at the end of a document, of a sentence, inside a sentence.
AT_DOCUMENT, AT_SENTENCE, INSIDE = 0, 8, 256


_LETTER, _SIGN = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def parts_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, cut further between ASCII letters and ASCII signs other than the apostrophe: no id spans such a place."""
    starts, ends, _ = words_of(data, offsets)
    letter, sign = _LETTER[data], _SIGN[data]
    inner = np.flatnonzero((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])) + 1
    first, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    first[starts], last[ends], first[inner], last[inner] = True, True, True, True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but for those before a byte above ASCII, which may be an accent that joins the letter."""
    upper = (data >= 65) & (data <= 90)
    upper[:-1] &= data[1:] < 128
    return data + upper * np.uint8(32)


class Words:
    """Ids of texts, part by part: each different part is encoded once as long as it is known.

    New parts are encoded as one text with a sign between them that none of them holds. The first KNOWN parts, among
    them all frequent ones, stay known; others until the next call.
    """

    BETWEEN = "\u2400"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = np.array(self.plain(self.BETWEEN), np.uint32)
        self.known: dict[str, int] = {}
        self.ids, self.begins = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.passing: list[str] = []

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def learn(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.begins) - 1
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def look_up(self, words: list[str]) -> np.ndarray:
        """The number of each part among the known ones."""
        known = self.known
        if self.passing:
            for w in self.passing:
                del known[w]
            self.begins = self.begins[: len(known) + 1].copy()
            self.ids = self.ids[: self.begins[-1]].copy()
            self.passing = []
        missing = [w for w in words if w not in known]
        if len(known) >= KNOWN:
            self.passing = missing
        odd = [w for w in missing if self.BETWEEN in w]
        for w in odd:
            ids = np.array(self.plain(w), np.uint32)
            self.learn([w], ids, np.array([len(ids)]))
        if odd:
            missing = [w for w in missing if self.BETWEEN not in w]
        if missing:
            ids = np.array(self.plain(f" {self.BETWEEN} ".join([*missing, ""])), np.uint32)
            width = len(self.between)
            gap = np.ones(len(ids) - width + 1, bool)
            for k, i in enumerate(self.between):
                gap &= ids[k : k + len(gap)] == i
            gap = np.flatnonzero(gap)
            sizes = np.diff(np.concatenate([[-width], gap])) - width
            drop = np.zeros(len(ids), bool)
            drop[(gap[:, None] + np.arange(width)).ravel()] = True
            self.learn(missing, ids[~drop], sizes)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each text's ids begin (one more for the end), and after which ids a sentence ends."""
        starts, ends, at = parts_of(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
        borders = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        packed = lowered(data)[~_SPACE[data]]
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(borders), pa.py_buffer(packed))
        coded = words.dictionary_encode()
        number = self.look_up(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sizes = np.diff(self.begins)[number]
        total = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat((self.begins[number] - total[:-1]).astype(np.int32), sizes)
        where += np.arange(total[-1], dtype=np.int32)
        gap = data[np.minimum(ends, len(data) - 1)]
        closed = (np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8)) & _SPACE[gap]) | (gap == 10)
        return self.ids[where], total[at], total[1:][closed]


_words: dict[str, Words] = {}


def words_of_worker(path: str) -> Words:
    """One bounded store of ids for each worker process, kept over the tasks that it runs."""
    if path not in _words:
        _words.clear()
        _words[path] = Words(path)
    return _words[path]


def cuts(n: int, documents: np.ndarray, sentences: np.ndarray, length: int) -> np.ndarray:
    """Where to cut n tokens into windows of at most ``length``: the window ends, the last one n.

    Least total of padding and cutting costs over all choices of document ends, sentence ends and, in long
    sentences, places STEP apart. The best predecessor of a place is the least of cost plus position among those not
    more than ``length`` before it, kept in a queue of rising values, so each place enters and leaves once.
    """
    places = distinct(np.concatenate([[0], documents, sentences, [n]]))
    wide = np.flatnonzero(np.diff(places) > length // 4)
    extra = [np.arange(places[i] + STEP, places[i + 1], STEP) for i in wide]
    inner = np.concatenate(extra) if extra else np.zeros(0, np.int64)
    places = distinct(np.concatenate([places, inner]))
    cost = np.full(len(places), AT_SENTENCE)
    cost[np.isin(places, inner)] = INSIDE
    cost[np.isin(places, documents)] = AT_DOCUMENT
    cost[-1] = 0
    at, price = places.tolist(), cost.tolist()
    best, before = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost plus position, index)
    for i in range(1, len(at)):
        here = at[i]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        least, before[i] = queue[0]
        best[i] = least + length - here + price[i]
        value = best[i] + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    found, i = [], len(at) - 1
    while i:
        found.append(at[i])
        i = before[i]
    found.reverse()
    return np.array(found, np.int64)


def _tail(start: int, end: int, length: int) -> list[int]:
    """Ends of the last window's parts: cut into powers of two, which need no padding, where that costs less."""
    rest, parts = end - start, []
    while rest:
        step = 1 << (rest.bit_length() - 1)
        rest -= step
        parts.append(end - rest)
    return parts if INSIDE * (len(parts) - 1) < length - (end - start) else [end]


class _Block:
    """Documents that are packed together, and what becomes of them."""

    def __init__(self, length: int):
        self.length, self.rows, self.ids, self.ends, self.sentences, self.n = length, [], [], [], [], 0

    def add(self, row: object, ids: np.ndarray, sentences: np.ndarray) -> None:
        self.rows.append(row)
        self.ids += [ids, np.array([END], np.uint32)]
        self.sentences.append(sentences + self.n)
        self.n += len(ids) + 1
        self.ends.append(self.n)

    def pieces(self, first: int) -> list[list]:
        ids, ends = np.concatenate(self.ids).astype("<u4"), np.array(self.ends)
        windows = cuts(self.n, ends, np.concatenate(self.sentences), self.length)
        start = int(windows[-2]) if len(windows) > 1 else 0
        windows = np.concatenate([windows[:-1], _tail(start, self.n, self.length)])
        stops = distinct(np.concatenate([ends, windows]))
        begins = np.concatenate([[0], stops[:-1]])
        doc, seq = np.searchsorted(ends, stops), np.searchsorted(windows, stops)
        doc_begin = np.concatenate([[0], ends[:-1]])
        seq_begin = np.concatenate([[0], windows[:-1]])
        raw = memoryview(ids.tobytes())
        return [
            [self.rows[d] for d in doc],
            begins - doc_begin[doc],
            stops - begins,
            [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)],
            (ends - doc_begin)[doc],
            first + seq,
            begins - seq_begin[seq],
        ]


_PIECES = pa.schema(
    [("doc_id", pa.int64()), *((c, pa.int64()) for c in
     ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))]
)


def _packer(path: str, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = words_of_worker(path), TaskContext.get().partitionId() << 40
        block = _Block(length)

        def done() -> pa.RecordBatch:
            nonlocal block, number
            columns = block.pieces(number)
            number = int(columns[5][-1]) + 1
            block = _Block(length)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], schema=_PIECES
            )

        for chunk in in_chunks(batches, "text", CHUNK):
            ids, begins, closed = words.encode(*text_bytes(chunk.column("text")))
            inside = np.searchsorted(closed, begins)
            for i, doc_id in enumerate(chunk.column("doc_id").to_pylist()):
                a, b = begins[i], begins[i + 1]
                block.add(doc_id, ids[a:b], closed[inside[i] : inside[i + 1]] - a)
                if block.n >= BLOCK:
                    yield done()
        if block.n:
            yield done()

    return run


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pack the texts of ``docs`` (doc_id long, text) into sequences of at most ``length`` tokens.

    ``tokenizer`` is the path of a tokenizer file that every task reaches. Documents stand in the order of doc_id
    (null first), then of a hash of the text. Ranges of them are tokenized, closed by the id END, and cut block by block where padding
    and cutting costs are least; a block's last sequence is split into powers of two, which need no padding, if that
    is cheaper than filling it.

    Returns one row per piece of a document: doc_id, start (ids of the document before it), length, ids_crc32 (of
    the ids as little-endian unsigned 32-bit numbers), doc_tokens, sequence_id, offset (in the sequence). Null, empty
    and wordless texts are the id END alone; texts of any length are cut over several sequences. Null ids and
    repeated rows are documents of their own. Empty tables give empty results; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = ", ".join(f"`{c}` long" for c in _PIECES.names)
    return ordered.mapInArrow(_packer(tokenizer, length), schema)
