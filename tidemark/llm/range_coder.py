"""Token ids as compact binary blocks: an adaptive, context-mixing range coder over ids of order 0 to 2.

Block layout (little-endian): ``TIDC``, version u8, alphabet u32, documents u32, ids u64, lanes u32, table bytes u32,
CRC-32 of the rest u32; then the zlib-packed document table (id i64, null flag u8, ids u32 each) and the coded words
(word count u32 per lane, then all 16-bit words, lane by lane). A block knows nothing of any other: the model starts
anew, the checksum covers table and words, so that blocks decode in any order and a damaged one is found.

The ids of a block are laid out on up to 4096 lanes (lane = a run of consecutive ids). Every step codes one id per
lane, each lane with its own arithmetic coder, all lanes from one model, so numpy works on whole columns. The model
predicts an id three ways: the id that followed the last two ids (order 2), the one that followed the last id
(order 1), and adaptive id frequencies (order 0). The confidence counts of both predictions select a context whose
learned shares mix the three; the coder narrows its interval to the chosen predictor and, for order 0, to the id.
Counts, predictions and shares adapt after every few steps, from ids that the decoder has by then as well.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored
from .tokens import VOCABULARY, crc, encoder

MAGIC, VERSION = b"TIDC", 1
HEAD = struct.Struct("<4sBIIQIII")
LANES = 4096
#: A block closes with the document that brings it to this many ids.
BLOCK_IDS = 1 << 20
SHARE_BITS, FREQ_BITS, SLOT_BITS = 12, 20, 17
_TOP, _LOW32 = np.uint64(48), np.uint64((1 << 32) - 1)
_W = np.uint64(16)
TABLE = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u4")])


def _chunks(steps: int) -> Iterator[tuple[int, int]]:
    """Runs of steps between two adaptations: short ones first."""
    at, size = 0, 1
    while at < steps:
        yield at, min(steps, at + size)
        at, size = at + size, min(32, size * 2)


class _Model:
    """Predictions for the next id; constant between two calls of ``adapt``."""

    def __init__(self, alphabet: int, decoding: bool) -> None:
        self.size, self.decoding = alphabet, decoding
        self.counts = np.zeros(alphabet, np.int64)
        self.next1, self.sure1 = np.zeros(alphabet, np.uint32), np.zeros(alphabet, np.int32)
        self.next2, self.sure2 = np.zeros(1 << SLOT_BITS, np.uint32), np.zeros(1 << SLOT_BITS, np.int32)
        self.hits = np.tile(np.array([1, 1, 2], np.int64), (32, 1))
        self._frequencies()
        self._shares()
        self._guesses()

    def _frequencies(self) -> None:
        room, total = (1 << FREQ_BITS) - self.size, max(1, int(self.counts.sum()))
        freq = 1 + self.counts * room // total
        freq[int(np.argmax(freq))] += (1 << FREQ_BITS) - int(freq.sum())
        self.freq = freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)
        if self.decoding:
            self.symbol = np.repeat(np.arange(self.size, dtype=np.uint16 if self.size <= 1 << 16 else np.uint32), freq)

    def _shares(self) -> None:
        room = (1 << SHARE_BITS) - 3
        share = 1 + self.hits * room // self.hits.sum(1, keepdims=True)
        share[:, 2] += (1 << SHARE_BITS) - share.sum(1)
        at = (np.cumsum(share, 1) - share).astype(np.uint64)
        self.share, self.share_at = share.astype(np.uint64).ravel(), at.ravel()  # by context * 3 + zone
        self.first, self.second = at[:, 1].copy(), at[:, 2].copy()

    def _guesses(self) -> None:
        """Prediction and its confidence side by side, so that one look-up gets both."""
        self.order1, self.order2 = ((guess << np.uint32(2)) | sure.astype(np.uint32) for guess, sure in ((self.next1, self.sure1), (self.next2, self.sure2)))

    def predict(self, last: np.ndarray, before: np.ndarray):
        """Slot of order 2, the two predicted ids, and the mixing context."""
        slot = ((before * np.uint32(0x9E3779B1)) ^ (last * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D) >> np.uint32(32 - SLOT_BITS)
        two, one = self.order2.take(slot), self.order1.take(last)
        context = ((two & np.uint32(3)) << np.uint32(3)) | ((one & np.uint32(3)) << np.uint32(1))
        two >>= np.uint32(2)
        one >>= np.uint32(2)
        context |= two == one
        return slot, two, one, context.astype(np.int64)

    def adapt(self, ids, last, slot, two, one, chosen) -> None:
        self.counts += 32 * np.bincount(ids, minlength=self.size)
        if self.counts.sum() > 1 << 28:
            self.counts >>= 1
        for key, seen, guess, sure in ((last, one, self.next1, self.sure1), (slot, two, self.next2, self.sure2)):
            np.add.at(sure, key, np.where(seen == ids, np.int32(1), np.int32(-1)))
            lost = np.flatnonzero((sure < 0).take(key))
            guess[key[lost]] = ids[lost]  # of several, the last id counts
            np.clip(sure, 0, 3, out=sure)
        self.hits += np.bincount(chosen, minlength=96).reshape(32, 3)
        self.hits = np.where(self.hits.sum(1, keepdims=True) > 1 << 16, (self.hits + 1) >> 1, self.hits)
        self._frequencies()
        self._shares()
        self._guesses()


def _settle(low, span, emit) -> None:
    """Shift out the leading 16-bit words that no longer change; a span too small is cut at a word border."""
    at = slice(None)
    while True:
        a, r = low[at], span[at]
        fixed = ((a ^ (a + r)) >> _TOP) == 0
        small = ~fixed & (r <= _LOW32)
        go = np.flatnonzero(fixed | small)
        if not len(go):
            return
        r = np.where(small, (~a + np.uint64(1)) & _LOW32, r)[go]
        at = go if isinstance(at, slice) else at[go]
        emit(at, low)
        low[at] <<= _W
        span[at] = r << _W


def _layout(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // 128))
    return lanes, -(-n // lanes)


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[int, bytes]:
    """Lanes and coded words of a block's ids."""
    n = len(ids)
    if not n:
        return 0, b""
    lanes, steps = _layout(n)
    grid = np.zeros(lanes * steps, np.uint32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64(0xFFFFFFFFFFFFFFFF))
    words, used = np.zeros((lanes, 2 * steps + 8), np.uint16), np.zeros(lanes, np.int64)

    def emit(at, low):
        words[at, used[at]] = low[at] >> _TOP
        used[at] += 1

    model = _Model(alphabet, False)
    history = np.concatenate([np.zeros((2, lanes), np.uint32), grid])
    for a, b in _chunks(steps):
        live = [-(-(n - s) // steps) if n > s else 0 for s in range(a, b)]
        cur, last, before = grid[a:b], history[a + 1 : b + 1], history[a:b]
        slot, two, one, context = model.predict(last, before)
        zone = np.where(cur == two, 0, np.where(cur == one, 1, 2))
        chosen, plain = context * 3 + zone, zone == 2
        share, share_at = model.share.take(chosen), model.share_at.take(chosen)
        freq = np.where(plain, model.freq.take(cur), np.uint64(1 << FREQ_BITS))
        cum = np.where(plain, model.cum.take(cur), np.uint64(0))
        for k, m in enumerate(live):
            lo, sp = low[:m], span[:m]
            part = sp >> np.uint64(SHARE_BITS)
            lo += share_at[k, :m] * part
            part = share[k, :m] * part >> np.uint64(FREQ_BITS)
            lo += cum[k, :m] * part
            sp[:] = freq[k, :m] * part
            _settle(lo, sp, emit)
        step = (cur, last, slot, two, one, chosen)
        if live[0] == live[-1]:  # all but the run in which a lane ends
            model.adapt(*(x[:, : live[0]].ravel() for x in step))
        else:
            on = np.arange(lanes)[None, :] < np.array(live)[:, None]
            model.adapt(*(x[on] for x in step))
    for _ in range(4):
        emit(np.arange(lanes), low)
        low <<= _W
    kept = np.arange(words.shape[1])[None, :] < used[:, None]
    return lanes, used.astype("<u4").tobytes() + words[kept].astype("<u2").tobytes()


def decode_ids(body: bytes, lanes: int, n: int, alphabet: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint32)
    steps = -(-n // lanes)
    used = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(body, "<u2", offset=4 * lanes), np.zeros(8, np.uint16)]).astype(np.uint64)
    at_word = np.cumsum(used) - used
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64(0xFFFFFFFFFFFFFFFF))
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _W) | words[at_word]
        at_word += 1

    def emit(at, low):
        code[at] = (code[at] << _W) | words[at_word[at]]
        at_word[at] += 1

    model = _Model(alphabet, True)
    history = np.zeros((steps + 2, lanes), np.uint32)
    top = np.uint64((1 << FREQ_BITS) - 1)
    for a, b in _chunks(steps):
        seen = []
        for s in range(a, b):
            m = -(-(n - s) // steps) if n > s else 0
            last, before = history[s + 1, :m], history[s, :m]
            slot, two, one, context = model.predict(last, before)
            lo, sp = low[:m], span[:m]
            part = sp >> np.uint64(SHARE_BITS)
            value = (code[:m] - lo) // part
            plain, guessed = value >= model.second.take(context), value < model.first.take(context)
            chosen = context * 3 + 1 - guessed + plain
            lo += model.share_at.take(chosen) * part
            part = model.share.take(chosen) * part >> np.uint64(FREQ_BITS)
            ids = np.where(guessed, two, one)
            sp[:] = part << np.uint64(FREQ_BITS)
            at = np.flatnonzero(plain)
            small, base = part[at], lo[at]
            ids[at] = coded = model.symbol.take(np.minimum((code[at] - base) // small, top).view(np.int64))
            lo[at] = base + model.cum.take(coded) * small
            sp[at] = model.freq.take(coded) * small
            _settle(lo, sp, emit)
            history[s + 2, :m] = ids
            seen.append((ids, last, slot, two, one, chosen))
        model.adapt(*(np.concatenate(x) for x in zip(*seen)))
    return history[2:].T.ravel()[:n]


def write_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, alphabet: int) -> bytes:
    table = np.zeros(len(doc_ids), TABLE)
    table["null"] = [d is None for d in doc_ids]
    table["id"] = [d or 0 for d in doc_ids]
    table["n"] = lengths
    packed = zlib.compress(table.tobytes(), 1)
    lanes, words = encode_ids(ids, alphabet)
    return HEAD.pack(MAGIC, VERSION, alphabet, len(table), len(ids), lanes, len(packed), zlib.crc32(packed + words)) + packed + words


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Document table and ids of a block; a damaged block raises ValueError."""
    magic, version, alphabet, n_docs, n, lanes, packed, check = HEAD.unpack_from(block)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token block of a known version")
    rest = block[HEAD.size :]
    if zlib.crc32(rest) != check:
        raise ValueError("token block fails its checksum")
    table = np.frombuffer(zlib.decompress(rest[:packed]), TABLE)
    if len(table) != n_docs or int(table["n"].sum()) != n:
        raise ValueError("token block has a wrong document table")
    return table, decode_ids(rest[packed:], lanes, n, alphabet)


BLOCKS = "part int, block int, n_docs long, n_ids long, payload binary"
DOCUMENTS = "part int, block int, inside long, doc_id long, n_tokens long, ids_crc32 long"


def encode_documents(docs: DataFrame, end_id: int = 2, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order (nulls first, equal ids by text), to be written as Parquet.

    ``part`` and ``block`` number the blocks in that order. A null or empty text has only the end id.
    """

    def blocks(batches):
        part, number = TaskContext.get().partitionId(), 0
        alphabet = encoder(vocabulary).model.get_vocab_size()
        doc_ids, lengths, ids, have = [], [], [], 0

        def close():
            row = [[part], [number], [len(doc_ids)], [have], [write_block(doc_ids, np.array(lengths), np.concatenate(ids), alphabet)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "block", "n_docs", "n_ids", "payload"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, flat, offsets in encoder(vocabulary).documents(batch.column(1), end_id):
                for i in range(len(offsets) - 1):
                    one = flat[offsets[i] : offsets[i + 1]]
                    doc_ids.append(names[first + i])
                    lengths.append(len(one))
                    ids.append(one)
                    have += len(one)
                    if have >= block_ids:
                        yield close()
                        number, doc_ids, lengths, ids, have = number + 1, [], [], [], 0
        if doc_ids:
            yield close()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return map_arrow(ordered, blocks, BLOCKS)


def decode_documents(blocks: DataFrame) -> DataFrame:
    """One row per document of stored blocks: id, number of ids, their CRC-32, and ids before it over all blocks."""

    def documents(batches):
        for batch in batches:
            for part, block, payload in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))):
                table, ids = read_block(payload)
                ends = np.cumsum(table["n"].astype(np.int64))
                starts = ends - table["n"]
                n = len(table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(table["id"], pa.int64(), mask=table["null"].astype(bool)), pa.array(table["n"].astype(np.int64)),
                     pa.array([crc(ids[a:b]) for a, b in zip(starts, ends)], pa.int64())],
                    ["part", "block", "inside", "doc_id", "n_tokens", "ids_crc32"])

    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    running = lambda w, c: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c)
    parts = parts.select("part", running(Window.orderBy("part"), "n").alias("part_start"))  # one row per file
    starts = sizes.join(parts, "part").select(
        "part", "block", (F.col("part_start") + running(Window.partitionBy("part").orderBy("block"), "n_ids")).alias("block_start"))
    decoded = map_arrow(blocks.select("part", "block", "payload"), documents, DOCUMENTS)
    return decoded.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, end_id: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode all documents, write the blocks, and decode them from the written files."""
    return decode_documents(stored(encode_documents(docs, end_id, vocabulary), "token-blocks"))
