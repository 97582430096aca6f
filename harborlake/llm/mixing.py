"""Language-model scoring by online logistic context mixing.

The event that is scored is a document's sequence of words (A-Z in lower case) with its end: each word
and a blank, then an end byte. A byte is coded as a path of binary decisions in a tree that
depends on the byte before it and, after a letter, on four bits of the one before that (Huffman trees of the
training texts), so usual bytes take few decisions.
Every decision is predicted in several contexts (the three bytes before, the five bytes before, the word so
far), each of which hashes to a slot with counts of zeros and ones gathered from all training documents. The
predictions are mixed in the logistic domain by weights that depend on a gate (whether the word so far is
known) and are corrected after every decision; the result is refined by a slope and a shift that are corrected
as well. Weights, slope and shift are handed on through a whole document, however long it is: it is cut into spans, which
run once to see where each ends and once from where the one before ended. All spans run side by side, so a score depends on
the text and the model alone and time follows the number of bytes.

As a baseline, each word counts with its smoothed frequency in the training documents.

Missing and empty texts are a lone end. Without training documents all counts are zero. Repeated rows and null
doc_ids keep a row each; a null doc_id is in the fold of the empty text. An empty table gives no rows; columns besides doc_id and text
are never read. A very long text is scored by one task, with 12 bytes of memory a byte.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from harborlake.llm.common import encoded, fold, slices, stored, texts

FOLDS, HELD_OUT = 5, 1
END = b"\n"  # no word holds it; it also stands before the first byte
CLASSES = 256 + 26 * 16
# Slots of each context: what follows three bytes, five bytes, a word so far.
SLOT_BITS = (19, 21, 22)
CONTEXTS = len(SLOT_BITS)
RATE = 0.02
REFINE_RATE = 0.02
START_WEIGHT = 0.45
PRIOR = 0.4
ORDERS = (3, 5)  # bytes before, of the contexts besides the word so far
KNOWN = 0.5
STEP = 0.1  # of log odds, which are kept as eight-bit numbers
LEAST = 1e-6  # probability that no decision falls below
SPAN = 4096  # decisions of a long text that run as one lane
_TILE = 64
_SCORED_BYTES = 8 << 20  # of texts that are scored side by side; long ones need others beside them
_CACHED_BYTES = 1 << 15
_TALLIED_BYTES = 1 << 18
_PART_BITS = 14
_BATCH_BYTES = 8 << 20
_BUCKET_BYTES = 8 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ENDS = END * 7
_CODEC = "zstd"


_SPACED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz     ")


def coded_text(text: bytes) -> bytes:
    """The words of ``spaced_words``, each with a blank, and the end."""
    spaced = text.translate(_SPACED)
    while b"  " in spaced:
        spaced = spaced.replace(b"  ", b" ")
    spaced = spaced.strip(b" ")
    return spaced + b" " + END if spaced else END


class Trees:
    """For each class of what stands before, a Huffman tree of the byte to come, as flat tables of decisions."""

    def __init__(self, pairs: np.ndarray):
        """``pairs``: counts of (class, byte)."""
        lengths, nodes, bits = [], [], []
        seen = pairs.reshape(CLASSES, 256)
        overall = seen.sum(axis=0)
        for before in range(CLASSES):
            # what never followed is ordered by how frequent it is anywhere
            weight = seen[before] * 1024.0 + 1 + overall / (overall.sum() + 1.0)
            heap = [(w, n, n) for n, w in enumerate(weight.tolist())]
            heapq.heapify(heap)
            children, number = {}, 256
            while len(heap) > 1:
                a, b = heapq.heappop(heap), heapq.heappop(heap)
                children[number] = (a[2], b[2])
                heapq.heappush(heap, (a[0] + b[0], number, number))
                number += 1
            paths: dict[int, list[tuple[int, int]]] = {}
            open_nodes = [(number - 1, [])]
            while open_nodes:
                node, path = open_nodes.pop()
                if node < 256:
                    paths[node] = path
                    continue
                for bit, child in enumerate(children[node]):
                    open_nodes.append((child, [*path, (before << 9 | node, bit)]))
            for byte in range(256):
                lengths.append(len(paths[byte]))
                nodes.extend(n for n, _ in paths[byte])
                bits.extend(b for _, b in paths[byte])
        self.lengths = np.array(lengths, dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        mixed = np.array(nodes, dtype=np.uint64) * _ODD
        # the bit of a decision stands above all bits of its salt that a slot takes
        self.salts = (mixed >> np.uint64(32)).astype(np.uint32) & np.uint32((1 << 31) - 1) | np.array(bits, dtype=np.uint32) << np.uint32(31)


def _before(data: np.ndarray, place: np.ndarray, back: int) -> np.ndarray:
    out = np.full(len(data), END[0], dtype=np.uint8)
    out[back:] = data[:-back] if back < len(data) else 0
    out[place < back] = END[0]
    return out


def _classed(b1: np.ndarray, b2: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Class and byte in one number; after a letter of ASCII, four bits of the byte before it count."""
    letter = (b1 >= 97) & (b1 <= 122)
    return np.where(letter, 256 - 97 * 16 + b1.astype(np.int32) * 16 + (b2 & 15), b1) << 8 | data


def pair_keys(found: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(found), dtype=np.uint8)
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return _classed(_before(data, place, 1), _before(data, place, 2), data)


def word_pairs(words: list[bytes], counts: np.ndarray, end: int) -> np.ndarray:
    """Counts of class and byte of words that stand in a text so often; a first word counts like any other."""
    some = [n for n in np.flatnonzero(counts).tolist() if n != end]
    keys = pair_keys([b" ".join([words[n] for n in some]) + b" "])
    times = np.repeat(counts[some], np.fromiter((len(words[n]) + 1 for n in some), np.int64, len(some))) if some else [0]
    pairs = np.bincount(keys, times, CLASSES << 8).astype(np.int64)
    pairs[ord(" ") << 8 | END[0]] += counts[end]
    return pairs


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and their inverses."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        base, inverse = int(_ODD), pow(int(_ODD), -1, 1 << 64)
        _POWERS.clear()
        tables = []
        for b in (base, inverse):
            t = np.empty(size, dtype=np.uint64)
            t[0], have = 1, 1
            while have < size:
                t[have : 2 * have] = t[:have] * np.uint64(pow(b, have, 1 << 64))
                have *= 2
            tables.append(t)
        _POWERS[size] = (tables[0], tables[1])
    return _POWERS[size]


def _scramble(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * _ODD
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)


def _pieces(text: bytes, limit: int, lead: int) -> Iterator[bytes]:
    """A text in pieces that begin at words, all but the first with the ``lead`` bytes before them."""
    low = 0
    while low < len(text):
        high = text.find(b" ", low + limit) + 1 or len(text)
        yield text[max(0, low - lead) : high]
        low = high


def decisions(
    found: list[bytes], trees: Trees, orders: tuple[int, int] = ORDERS
) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray, bool]]:
    """Of some texts at a time, so that arrays stay in the cache: bit of each decision, its slot in each context,
    decisions of each text. A long text comes in pieces; the last value says that the first text goes on."""
    for some, lead, goes_on in _cached(found, max(orders), _CACHED_BYTES):
        yield *_decisions(some, trees, orders, lead), goes_on


def _cached(found: list[bytes], lead: int, limit: int) -> Iterator[tuple[list[bytes], int, bool]]:
    """Some texts at a time, or a piece of a long one; with the bytes of it that stand in the piece before, and if it goes on."""
    at = 0
    while at < len(found):
        stop, size = at, 0
        while stop < len(found) and (stop == at or size + len(found[stop]) <= limit):
            size += len(found[stop])
            stop += 1
        if stop == at + 1:
            for number, piece in enumerate(_pieces(found[at], limit, lead)):
                yield [piece], lead if number else 0, number > 0
        else:
            yield found[at:stop], 0, False
        at = stop


def _coded_bytes(
    found: list[bytes], trees: Trees, orders: tuple[int, int], lead: int
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte, the hashes of its contexts, where its path starts and the decisions on it; of each text, its first byte."""
    joined = _ENDS + b"".join(found)
    data = np.frombuffer(joined, dtype=np.uint8)[len(_ENDS) :]
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    first = np.cumsum(sizes) - sizes
    # each byte with the seven before it, the last one lowest; before a text there are ends
    context = np.ndarray(len(data), ">u8", joined, strides=(1,)).astype(np.uint64)
    for k in range(max(orders)):
        at, own = first[sizes > k] + k, np.uint64((1 << 8 * (k + 1)) - 1)
        context[at] = context[at] & own | np.uint64(int.from_bytes(_ENDS + END, "big")) & ~own
    context >>= np.uint64(8)
    hashes = [_scramble(context & np.uint64((1 << 8 * k) - 1), k) for k in sorted(orders)]
    last, second = context.astype(np.uint8), (context >> np.uint64(8)).astype(np.uint8)
    power, inverse = _powers(len(data) + 1)
    at, begins = np.arange(len(data)), last == 32
    begins[first] = True
    word = np.maximum.accumulate(np.where(begins, at, 0))
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * power[: len(data)])])
    hashes.append(_scramble((summed[at] - summed[word]) * inverse[word], 0))
    pair = _classed(last, second, data).astype(np.intp)
    lengths = trees.lengths.take(pair, mode="wrap")
    lengths[:lead] = 0  # coded with the piece before
    return hashes, trees.starts.take(pair, mode="wrap"), lengths, first


def _decisions(
    found: list[bytes], trees: Trees, orders: tuple[int, int], lead: int
) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    hashes, starts, lengths, first = _coded_bytes(found, trees, orders, lead)
    ends = np.cumsum(lengths)
    # Numbers are as wide as Spark's machines count, and wrapped instead of checked: taking is much faster then.
    owner = np.repeat(np.arange(len(lengths)), lengths)
    path = (starts - ends + lengths).take(owner, mode="wrap")
    path += np.arange(len(path))
    salts = trees.salts.take(path, mode="wrap")
    slots = []
    for h, b in zip(hashes, SLOT_BITS):
        own = h.take(owner, mode="wrap")
        own += salts
        own &= np.uint32((1 << b) - 1)
        slots.append(own.astype(np.intp))
    return (salts >> np.uint32(31)).astype(np.uint8), slots, np.add.reduceat(lengths, first)


def tally(tables: list[np.ndarray], found: list[bytes], trees: Trees) -> None:
    """Add the decisions of some texts to the counts of zeros and ones, side by side, of their slots in each context.

    Counts don't ask for the order of decisions: bytes stand by how many they take, so that all that take a k-th one are the first of them.
    """
    turned = trees.salts << np.uint32(1) | trees.salts >> np.uint32(31)  # the bit below the salt
    for some, lead, _ in _cached(found, max(ORDERS), _TALLIED_BYTES):
        hashes, starts, lengths, _ = _coded_bytes(some, trees, ORDERS, lead)
        order = np.argsort((-lengths).astype(np.int16), kind="stable")
        hashes, path = [h.take(order, mode="wrap") << np.uint32(1) for h in hashes], starts.take(order, mode="wrap")
        for n in (len(lengths) - np.cumsum(np.bincount(lengths))[:-1]).tolist():
            salts = turned.take(path[:n], mode="wrap")
            path[:n] += 1
            for table, h, b in zip(tables, hashes, SLOT_BITS):
                own = h[:n] + salts
                own &= np.uint32((2 << b) - 1)
                np.add.at(table, own.astype(np.intp), np.uint32(1))


class _Grown:
    """Rows of a decision put one after the other, without a second copy: its bit and its input in each context, a byte each."""

    def __init__(self):
        self.data, self.size = np.zeros((1 << 18, 1 + CONTEXTS), dtype=np.int8), 0

    def more(self, n: int) -> np.ndarray:
        low, self.size = self.size, self.size + n
        if self.size > len(self.data):
            self.data.resize((self.size + (self.size >> 3), 1 + CONTEXTS), refcheck=False)
        return self.data[low : self.size]


def costs(found: list[bytes], trees: Trees, stretch: list[np.ndarray]) -> np.ndarray:
    """Bits that each coded text costs."""
    grown, sizes = _Grown(), []
    for truth, slots, per_text, goes_on in decisions(found, trees):
        rows = grown.more(len(truth))
        rows[:, 0] = truth
        if goes_on:
            sizes[-1][-1] += per_text[0]
        else:
            sizes.append(per_text)
        for k, own in enumerate(slots):
            rows[:, k + 1] = stretch[k].take(own, mode="wrap")
        del rows
    if not sizes:
        return np.zeros(0)
    grown.more(_TILE)[:] = 0
    return _mixed(grown.data[: grown.size], np.concatenate(sizes))


def _mixed(rows: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Bits that each text costs; long texts are cut into spans that run side by side with all others.

    Every span starts as a text does, and is then run once more, but for the first of a text, from where the span before it ended: by
    then, what it had started from is forgotten. The last of several spans runs the second time only, as none goes on from it. So time
    follows the number of decisions, and not the longest text.
    """
    spans = -(-per_text // SPAN)
    text = np.repeat(np.arange(len(per_text)), spans)
    number = np.arange(len(text)) - np.repeat(np.cumsum(spans) - spans, spans)
    start = np.repeat(np.cumsum(per_text) - per_text, spans) + number * SPAN
    size = np.minimum(SPAN, per_text[text] - number * SPAN)
    later = np.flatnonzero(number)
    early = np.flatnonzero((number == 0) | (number + 1 < spans[text]))
    cost, place = np.empty(len(text)), np.cumsum((number == 0) | (number + 1 < spans[text])) - 1
    cost[early], ended = _advanced(rows, number[early] == 0, start[early], size[early], None)
    if len(later):
        cost[later], _ = _advanced(rows, np.ones(len(later), dtype=bool), start[later], size[later], ended[:, place[later - 1]])
    return np.bincount(text, cost, minlength=len(per_text))


def _advanced(rows: np.ndarray, priced: np.ndarray, starts: np.ndarray, sizes: np.ndarray, state: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """All spans advance side by side, a decision at a time, longest first; gives their cost, and weights, slope and shift at their end.

    Spans that are not ``priced`` are as long as any, and their cost stays 0.

    Weights and shifts are kept with their sign turned, so that a step needs no negation, and inputs times the root of
    the rate (weights divided by it), so that errors need not be scaled.

    The weight of an input is one number, plus another where the gate is open: the word so far is known.
    """
    owner = np.lexsort((priced, -sizes))
    free = len(owner) - int(priced.sum())  # stand first
    size, start = sizes[owner], starts[owner]
    lanes, steps = len(owner), int(size[0])
    active = np.searchsorted(-size, -np.arange(steps), side="left")  # lanes longer than each step
    now = np.zeros((2 * CONTEXTS + 2, lanes), dtype=np.float32)  # weights, those of the open gate last, slope and shift
    if state is None:
        now[:CONTEXTS], now[-2] = -START_WEIGHT / RATE**0.5, 1
    else:
        now[:] = state[:, owner]
    weights, slope, shift = now[:-2], now[-2], now[-1]
    products = np.empty_like(weights)
    cost, buffers = np.zeros(lanes), np.empty((3, lanes), dtype=np.float32)
    # a row is taken as one number of four bytes
    view = np.lib.stride_tricks.sliding_window_view(rows.view(np.int32)[:, 0], _TILE)
    room = np.empty(_TILE * 2 * CONTEXTS * lanes, dtype=np.float32)
    refine, one, step_size, known_size = np.float32(REFINE_RATE), np.float32(1), np.float32(STEP * RATE**0.5), np.float32(KNOWN * RATE**0.5)
    least, most = np.float32(LEAST), np.float32(1 - LEAST)
    add, multiply, subtract = np.add, np.multiply, np.subtract
    for low in range(0, steps, _TILE):  # the inputs of some steps of all lanes are laid out at a time
        n = int(active[low])
        at = start[:n] + low
        own = np.ascontiguousarray(view[at].T).view(np.int8).reshape(_TILE, n, 1 + CONTEXTS)
        truth = own[:, :, 0].astype(np.float32)
        laid = room[: _TILE * 2 * CONTEXTS * n].reshape(_TILE, 2 * CONTEXTS, n)
        for k in range(CONTEXTS):
            multiply(own[:, :, k + 1], step_size, out=laid[:, k])
        known = (np.abs(laid[:, CONTEXTS - 1]) > known_size).astype(np.float32)
        multiply(laid[:, :CONTEXTS], known[:, None], out=laid[:, CONTEXTS:])
        chance = np.zeros((_TILE, n - free), dtype=np.float32)
        m = -1
        for step in range(min(_TILE, steps - low)):
            if m != active[low + step]:
                m = int(active[low + step])
                x, p, e = buffers[:, :m]
                w, product, a, b = weights[:, :m], products[:, :m], slope[:m], shift[:m]
            s, t = laid[step, :, :m], truth[step, :m]
            add.reduce(multiply(w, s, out=product), axis=0, out=x)
            np.reciprocal(add(np.exp(x, out=p), one, out=p), out=p)
            subtract(t, p, out=e)
            subtract(w, multiply(s, e, out=product), out=w)
            # the mixed prediction is refined by a slope and a shift that follow its errors
            add(multiply(a, x, out=p), b, out=p)
            np.reciprocal(add(np.exp(p, out=p), one, out=p), out=p)
            subtract(t, p, out=e)
            np.abs(e[free:], out=chance[step, : m - free])
            multiply(e, refine, out=e)
            subtract(b, e, out=b)
            subtract(a, multiply(x, e, out=x), out=a)
        np.subtract(one, chance, out=chance)  # what no step has written stays 1
        if steps - low >= _TILE and m == n:
            np.clip(chance, least, most, out=chance)
        else:
            for step in range(min(_TILE, steps - low)):
                own = chance[step, : int(active[low + step]) - free]
                np.clip(own, least, most, out=own)
        some = chance.reshape(_TILE // 4, 4, n - free)  # four factors of at least LEAST are far from the least number
        some = some[:, 0] * some[:, 1] * some[:, 2] * some[:, 3]
        cost[free:n] -= np.log2(some, out=some).sum(axis=0, dtype=np.float64)
    out, ended = np.empty(lanes), np.empty_like(now)
    out[owner], ended[:, owner] = cost, now
    return out, ended


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(~F.col("held_out")).select("text")


def byte_pairs(batches: DataFrame) -> np.ndarray:
    """Counts of class and byte of all training texts: 256 numbers a class."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES << 8, dtype=np.int64)
        for packed in (p for part in parts for p in part.column("pairs").to_pylist()):
            own = np.frombuffer(packed, dtype=np.int64).reshape(2, -1)
            total[own[0]] += own[1]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["pair", "n"])

    out = np.zeros(CLASSES << 8)
    found = batches.select("pairs").mapInArrow(counted, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for r in found.collect():
        out[r.pair] = r.n
    return out


def gathered(docs: DataFrame, trees: Trees) -> list[np.ndarray]:
    """Log odds of each slot of each context, in steps of STEP, from the counts of all training texts.

    Every task counts into tables of fixed size and sends the slots that it met, in parts of 2**14; what is sent
    grows with the corpus, the sum is one number for each slot whatever its size.
    """
    size = 2 << _PART_BITS
    ends = np.cumsum([2 << b for b in SLOT_BITS])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ends[-1], dtype=np.uint32)
        tables = np.split(counts, ends[:-1])
        for batch in slices(batches):
            tally(tables, [coded_text(t) for t in encoded(batch.column("text"))], trees)
        codec = pa.Codec(_CODEC, 1)
        for part, own in enumerate(counts.reshape(-1, size)):
            at = np.flatnonzero(own).astype(np.uint16)
            if len(at):
                packed = codec.compress(at.tobytes() + own[at].tobytes(), asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([len(at)], pa.int32()), pa.array([packed], pa.binary())],
                    ["part", "slots", "counts"],
                )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sums = pa.Codec(_CODEC, 1), {}
        for batch in batches:
            for part, n, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "slots", "counts"))):
                data = codec.decompress(packed, n * 6, asbytes=True)
                total = sums.setdefault(part, np.zeros(size, dtype=np.int64))
                total[np.frombuffer(data, np.uint16, n)] += np.frombuffer(data, np.uint32, n, n * 2)
        for part, total in sums.items():
            odds = np.log((total[1::2] + PRIOR) / (total[::2] + PRIOR)) / STEP
            odds = np.clip(np.rint(odds), -127, 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([odds.tobytes()], pa.binary())], ["part", "odds"])

    sent = _training(docs).mapInArrow(counted, "part int, slots int, counts binary")
    stretch = np.zeros((ends[-1] // size, size // 2), dtype=np.int8)
    for r in sent.repartition("part").mapInArrow(merged, "part int, odds binary").toLocalIterator():
        stretch[r.part] = np.frombuffer(r.odds, dtype=np.int8)
    return np.split(stretch.ravel(), ends[:-1] // 2)


def mixed_bits(docs: DataFrame, trees: Trees, stretch: list[np.ndarray]) -> DataFrame:
    """One row per document: doc_id, text_hash, held_out, coded_bytes, bits."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((vars(trees), stretch))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, stretch = sent.value
        np.seterr(over="ignore")  # a sure decision has odds beyond single precision; its probability is 0 or 1
        trees = Trees.__new__(Trees)
        trees.__dict__.update(state)
        for batch in slices(batches, _SCORED_BYTES):
            found = [coded_text(t) for t in encoded(batch.column("text"))]
            cost = costs(found, trees, stretch)
            columns = [batch.column(c) for c in ("doc_id", "text_hash", "held_out")]
            columns += [pa.array([len(t) for t in found], pa.int64()), pa.array(cost)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "held_out", "coded_bytes", "bits"])

    return docs.mapInArrow(scored, "doc_id long, text_hash long, held_out boolean, coded_bytes long, bits double")


def _cut(words: pa.BinaryArray) -> list[bytes]:
    """As ``to_pylist`` of an array without nulls, but faster for many short values."""
    _, ends, data = words.buffers()
    at = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1].tolist() if len(words) else [0]
    joined = data.to_pybytes() if data else b""
    return [joined[a:b] for a, b in zip(at, at[1:])]


def word_batches(docs: DataFrame) -> DataFrame:
    """Documents in batches, stored, each with its distinct words in the order of their hashes and their training counts.

    A text is a row of numbers in its batch's list of words. Counts of byte pairs of the training texts are noted, too.
    """

    def listed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, codec = TaskContext.get().partitionId() << 32, pa.Codec(_CODEC, 1)
        for number, batch in enumerate(slices(parts, _BATCH_BYTES)):
            held = batch.column("held_out").to_pylist()
            listed_words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(batch.column("text"))))
            found = listed_words.flatten().cast(pa.binary()).dictionary_encode()
            words = _cut(found.dictionary)
            # the end stands as no bytes, which no word is; a text without words splits into just that
            end = words.index(b"") if b"" in words else len(words)
            words += [b""] * (end == len(words))
            lengths = np.asarray(pc.list_value_length(listed_words)).astype(np.int64)
            ids, ends = np.asarray(found.indices), np.cumsum(lengths)
            lone = (lengths == 1) & (ids[ends - 1] == end)
            ids = np.insert(ids, ends[~lone], end)
            sizes = lengths + ~lone
            train = np.repeat(~np.array(held, dtype=bool), sizes)
            hashes = np.fromiter(map(crc32, words), dtype=np.uint32, count=len(words))
            order = np.argsort(hashes, kind="stable")
            place = np.empty(len(order), dtype=np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            ids = place[ids]
            counts = np.bincount(ids[train], minlength=len(words))
            pairs = word_pairs(words, counts[place], end)
            some = np.flatnonzero(pairs)
            joined = b"\n".join([words[n] for n in order.tolist()])
            row = {
                "batch": [first + number],
                "doc_ids": [batch.column("doc_id").to_pylist()],
                "text_hashes": [batch.column("text_hash").to_pylist()],
                "sizes": [sizes.tolist()],
                "ids": [codec.compress(ids.tobytes(), asbytes=True)],
                "hashes": [hashes[order].tobytes()],
                "counts": [counts.tobytes()],
                "words": [codec.compress(joined, asbytes=True)],
                "word_bytes": [len(joined)],
                "n": [int(counts.sum())],
                "pairs": [np.concatenate([some, pairs[some]]).tobytes()],
            }
            yield pa.RecordBatch.from_pydict(row, schema=_BATCH)
            del listed_words, found, words, row
            pa.default_memory_pool().release_unused()

    return stored(docs.mapInArrow(listed, _BATCH_SQL), "word_batches")


def summed_words(batches: DataFrame) -> DataFrame:
    """(batch, bucket, sums, distinct): training counts over all batches of the words of each batch, in the order of its list.

    Hashes are cut into buckets of about ``_BUCKET_BYTES`` of words, however many batches there are. Each batch sends its
    words of a bucket with their counts, and once more to ask for the sums; the answers follow the last counts, so a
    task holds the distinct words of one bucket. A frequent word comes once from each batch.
    """
    buckets = 1 + (batches.agg(F.sum("word_bytes")).first()[0] or 0) // _BUCKET_BYTES

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(_CODEC, 1)
        for part in parts:
            for batch, size, *packed in zip(*(part.column(c).to_pylist() for c in ("batch", "word_bytes", "hashes", "counts", "words"))):
                hashes, counts = np.frombuffer(packed[0], np.uint32), np.frombuffer(packed[1], np.int64)
                words = codec.decompress(packed[2], size, asbytes=True).split(b"\n")
                bucket = (hashes.astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                met = np.flatnonzero(np.diff(bucket, prepend=-1))
                rows = []
                for low, high in zip(met.tolist(), [*met[1:].tolist(), len(words)]):
                    joined, own = b"\n".join(words[low:high]), counts[low:high]
                    trained = np.flatnonzero(own)
                    if len(trained):
                        some = joined if len(trained) == high - low else b"\n".join([words[low + n] for n in trained.tolist()])
                        rows.append((bucket[low], False, batch, some, own[trained].tobytes()))
                    rows.append((bucket[low], True, batch, joined, b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE.types)], schema=_PIECE)

    def answered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums, told = None, {}, False
        for part in parts:
            rows = []
            for bucket, asks, batch, joined, counts in zip(*(part.column(n).to_pylist() for n in _PIECE.names)):
                if bucket != at:
                    at, sums, told = bucket, {}, False
                words = joined.split(b"\n")
                if not asks:
                    for w, c in zip(words, np.frombuffer(counts, np.int64).tolist()):
                        sums[w] = sums.get(w, 0) + c
                    continue
                own = np.array([sums.get(w, 0) for w in words], dtype=np.int64)
                rows.append((batch, bucket, own.tobytes(), 0 if told else len(sums)))
                told = True
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SUMS.types)], schema=_SUMS)

    pieces = batches.select("batch", "word_bytes", "hashes", "counts", "words").mapInArrow(cut, _PIECE_SQL)
    sent = pieces.repartition(int(buckets), "bucket").sortWithinPartitions("bucket", "asks")
    return stored(sent.mapInArrow(answered, _SUMS_SQL), "word_sums")


def baseline(batches: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_tokens, n_known, train_tokens, base_score) of each distinct document of the batches."""
    sums = summed_words(batches)
    n = batches.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    v = sums.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    norm = float(np.log10(n + 0.5 * (v + 1)))

    def added(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(_CODEC, 1)
        for part in parts:
            for r in range(part.num_rows):
                row = part.slice(r, 1)
                sizes = np.asarray(row.column("sizes").flatten()).astype(np.int64)
                c = np.frombuffer(b"".join(row.column("sums").flatten().to_pylist()), np.int64)
                total = int(sizes.sum())
                ids = np.frombuffer(codec.decompress(row.column("ids")[0].as_py(), total * 4, asbytes=True), np.int32)
                starts = np.cumsum(sizes) - sizes
                score = np.add.reduceat(np.log10(c + 0.5)[ids], starts) - sizes * norm
                known = np.add.reduceat((c > 0).astype(np.int64)[ids], starts)
                columns = [row.column("doc_ids").flatten(), row.column("text_hashes").flatten(), pa.array(sizes), pa.array(known), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_tokens", "n_known", "base_score"])

    parts = sums.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("bucket", "sums"))).alias("parts"))
    found = (
        batches.select("batch", "doc_ids", "text_hashes", "sizes", "ids")
        .join(parts.select("batch", F.col("parts.sums").alias("sums")), "batch")
        .select("doc_ids", "text_hashes", "sizes", "ids", "sums")
        .mapInArrow(added, "doc_id long, text_hash long, n_tokens long, n_known long, base_score double")
    )
    found = found.groupBy("doc_id", "text_hash").agg(*[F.first(c).alias(c) for c in ("n_tokens", "n_known", "base_score")])
    return found.withColumn("train_tokens", F.lit(n).cast("long"))


_BATCH_SQL = """batch long, doc_ids array<long>, text_hashes array<long>, sizes array<int>, ids binary,
    hashes binary, counts binary, words binary, word_bytes long, n long, pairs binary"""
_BATCH = pa.schema(
    [
        ("batch", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("text_hashes", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int32())),
        ("ids", pa.binary()),
        ("hashes", pa.binary()),
        ("counts", pa.binary()),
        ("words", pa.binary()),
        ("word_bytes", pa.int64()),
        ("n", pa.int64()),
        ("pairs", pa.binary()),
    ]
)
_PIECE_SQL = "bucket long, asks boolean, batch long, words binary, counts binary"
_PIECE = pa.schema([("bucket", pa.int64()), ("asks", pa.bool_()), ("batch", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
_SUMS_SQL = "batch long, bucket long, sums binary, distinct long"
_SUMS = pa.schema([("batch", pa.int64()), ("bucket", pa.int64()), ("sums", pa.binary()), ("distinct", pa.int64())])


def model_scores(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``score`` and ``base_score`` are log10 probabilities of the same words with their end.
    """
    rows = texts(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("text_hash"),
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
    )
    batches = word_batches(rows)
    trees = Trees(byte_pairs(batches))
    scored = mixed_bits(rows, trees, gathered(rows, trees))
    base = baseline(batches).withColumnRenamed("doc_id", "base_id").withColumnRenamed("text_hash", "base_hash")
    same = scored.doc_id.eqNullSafe(base.base_id) & (scored.text_hash == base.base_hash)
    return scored.join(base, same).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        (F.col("bits") * float(-np.log10(2))).alias("score"),
        (F.col("bits") / F.col("coded_bytes")).alias("bits_per_byte"),
    )
