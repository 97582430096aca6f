"""Byte-pair encoding and decoding with a minimal acyclic transducer as lexicon.

The pieces of the whole corpus (words with the blank before them, numbers, signs, white space) are counted;
the most frequent ones are encoded once and compiled into an automaton that shares prefixes and
suffixes. Its arcs carry numbers that add up to the place of a word among all words, and by that place
the ids of the word are found. The automaton is four flat arrays, which every task maps
into memory. Pieces that it does not hold are merged pair by pair, lowest rank first, so the ids are
those of plain encoding whatever the lexicon holds: its size only decides the speed.

The text of a special token is that token. A missing text is empty and has no ids. Repeated rows and
null doc_ids keep a row each. Long texts are encoded whole, long pieces with a heap. Which of equally
frequent pieces the lexicon holds makes no difference. An empty table gives no rows; columns besides doc_id and text are never read.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from harborlake.llm.common import slices, stored, texts

# Fixed value: how byte-level vocabularies of this family cut a text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts of Latin letters alone (up to U+024F, where all but two signs from U+00C0 are letters).
_LETTERS, _NUMBERS, _SPACES = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r\x20\x85\xa0"
LATIN_PIECES = (
    f" ?[{_LETTERS}]+| ?[{_NUMBERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
LEXICON_WORDS = 1 << 16
LONGEST_WORD = 64
_LOCKSTEP = 32
_KNOWN = 1 << 20
_COUNTED = 1 << 19
_NEVER = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte: itself if it is printable, else the next ones from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, n = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b], n = chr(n), n + 1
    return [letters[b] for b in range(256)]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each stretch, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


class Merges:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, state: dict):
        self.__dict__.update(state)

    @classmethod
    def read(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte_of = {c: b for b, c in enumerate(letters)}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in special.items()}
        size = max(tokens) + 1
        spelled = [tokens.get(i, b"") for i in range(size)]
        return cls(
            {
                "keys": keys[order],
                "ranks": order.astype(np.int32),
                "made": made[order].astype(np.int32),
                "of_byte": np.array([vocab[c] for c in letters], dtype=np.int32),
                "special": special,
                "spelling": np.frombuffer(b"".join(spelled), dtype=np.uint8),
                "spelling_ends": np.cumsum([0, *map(len, spelled)]).astype(np.int64),
            }
        )

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (right >= 0), self.ranks[at], _NEVER), at

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has.

        Words of like length are merged side by side, one merge of each at a time.
        """
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.cumsum(sizes) - sizes
        letters = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n in np.flatnonzero(sizes > _LOCKSTEP).tolist():
            own = self._encode_long(words[n])
            found.append((np.array([n]), np.array([len(own)]), own))
        for width in range(4, _LOCKSTEP + 1, 4):
            members = np.flatnonzero((sizes <= width) & (sizes > width - 4))
            if not len(members):
                continue
            ids, columns = np.full((len(members), width), -1, dtype=np.int32), np.arange(width)
            ids[columns < sizes[members][:, None]] = letters[_spread(first[members], sizes[members])]
            rows = np.arange(len(members))
            while len(rows):
                now = ids[rows]
                ranks, at = self._ranked(now[:, :-1], now[:, 1:])
                best = ranks.argmin(axis=1)
                each = np.arange(len(rows))
                some = ranks[each, best] < _NEVER
                rows, now, best, at = rows[some], now[some], best[some], at[each, best][some]
                now = np.concatenate([now, np.full((len(rows), 1), -1, dtype=np.int32)], axis=1)
                now = np.take_along_axis(now, columns + (columns > best[:, None]), axis=1)
                now[np.arange(len(rows)), best] = self.made[at]
                ids[rows] = now
            found.append((members, (ids >= 0).sum(axis=1), ids[ids >= 0]))
        counts = np.zeros(len(words), dtype=np.int64)
        for members, own, _ in found:
            counts[members] = own
        out, starts = np.empty(int(counts.sum()), dtype=np.int64), np.cumsum(counts) - counts
        for members, own, ids in found:
            out[_spread(starts[members], own)] = ids
        return out, counts

    def _encode_long(self, word: bytes) -> np.ndarray:
        ids = self.of_byte[np.frombuffer(word, dtype=np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def rank(a: int, b: int) -> tuple[int, int]:
            if (ids[a], ids[b]) not in known:
                r, at = self._ranked(np.array([ids[a]]), np.array([ids[b]]))
                known[ids[a], ids[b]] = int(r[0]), int(self.made[at[0]])
            return known[ids[a], ids[b]]

        heap = []

        def offer(a: int) -> None:
            if a >= 0 and after[a] >= 0 and (r := rank(a, after[a]))[0] < _NEVER:
                heapq.heappush(heap, (r[0], a, ids[a], ids[after[a]], r[1]))

        for a in range(len(ids)):
            offer(a)
        while heap:
            _, a, left, right, made = heapq.heappop(heap)
            b = after[a]
            if ids[a] != left or b < 0 or ids[b] != right:
                continue
            ids[a], ids[b] = made, -1
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a])
            offer(a)
        return np.array([i for i in ids if i >= 0], dtype=np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        starts = self.spelling_ends[ids]
        return self.spelling[_spread(starts, self.spelling_ends[ids + 1] - starts)].tobytes()


class Lexicon:
    """Words to ids by a minimal acyclic automaton whose arcs add up to a word's place.

    Arrays: arcs by state and letter (sorted), where each leads and what it adds, which states end a
    word, and the ids of all words by place.
    """

    FIELDS = ("arcs", "targets", "outputs", "final", "id_ends", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> Lexicon:
        """``words`` in ascending order, the ids of all of them, and how many each has. States with the same continuations become one as soon as they are complete."""
        registry: dict[tuple, int] = {}
        frozen: list[tuple[bool, list[tuple[int, int]]]] = []

        def freeze(state) -> int:
            key = (state[0], tuple(state[1]))
            if key not in registry:
                registry[key] = len(frozen)
                frozen.append((state[0], list(state[1])))
            return registry[key]

        path, last = [[False, []]], b""  # open states along the last word: final, arcs
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            while len(path) > same + 1:
                done = freeze(path.pop())
                path[-1][1].append((last[len(path) - 1], done))
            path.extend([False, []] for _ in word[same:])
            path[-1][0], last = True, word
        while len(path) > 1:
            done = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        root = freeze(path.pop())
        # the root becomes state 0, then the words below each state are counted, targets before sources
        number = [n + 1 if n < root else 0 if n == root else n for n in range(len(frozen))]
        below, arcs = [0] * len(frozen), []
        for n, (final, own) in enumerate(frozen):
            below[n] = int(final)
            for letter, target in own:
                arcs.append((number[n] << 8 | letter, number[target], below[n]))
                below[n] += below[target]
        arcs.sort()
        table = np.array(arcs, dtype=np.int64).reshape(-1, 3)
        final = np.zeros(len(frozen), dtype=np.int64)
        for n, (is_final, _) in enumerate(frozen):
            final[number[n]] = is_final
        return cls(
            {
                "arcs": table[:, 0].copy(),
                "targets": table[:, 1].copy(),
                "outputs": table[:, 2].copy(),
                "final": final,
                "id_ends": np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
                "ids": ids.astype(np.int64),
            }
        )

    def tobytes(self) -> bytes:
        arrays = [getattr(self, f) for f in self.FIELDS]
        head = np.array([len(a) for a in arrays], dtype=np.int64)
        return b"".join(a.tobytes() for a in (head, *arrays))

    @classmethod
    def mapped(cls, data: bytes) -> Lexicon:
        """Arrays over a memory-mapped file without a name, which goes away with the task's process."""
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            memory = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), dtype=np.int64)
        ends = np.cumsum([len(cls.FIELDS), *memory[: len(cls.FIELDS)]])
        return cls({f: memory[a:b] for f, a, b in zip(cls.FIELDS, ends, ends[1:])})

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word among the words of the lexicon, -1 for others; all are walked letter by letter at once."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.cumsum(lengths) - lengths
        letters = np.frombuffer(b"".join(words), dtype=np.uint8)
        out = np.full(len(words), -1, dtype=np.int64)
        going, state, total, at = np.arange(len(words)), np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64), 0
        while len(going) and len(self.arcs):
            ended = lengths[going] == at
            good = ended & (self.final[state] == 1)
            out[going[good]] = total[good]
            going, state, total = going[~ended], state[~ended], total[~ended]
            key = state << 8 | letters[starts[going] + at]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            there = self.arcs[arc] == key
            going, state, total = going[there], self.targets[arc[there]], total[there] + self.outputs[arc[there]]
            at += 1
        return out


class Cutter:
    """Cuts texts into special tokens and pieces."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.pieces, self.latin = regex.compile(PIECES), re.compile(LATIN_PIECES)
        self.beyond = re.compile("[^\x00-\u024f]")
        names = sorted(special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def __call__(self, text: str) -> list[str]:
        find = self.pieces.findall if self.beyond.search(text) else self.latin.findall
        if self.marks is None or not any(name in text for name in self.special):
            return find(text)
        out = []
        for part in self.marks.split(text):
            out.extend([part] if part in self.special else find(part))
        return out


class _Numbered(dict):
    """Pieces to numbers; a new piece gets the next one and is noted."""

    def __init__(self, *args):
        super().__init__(*args)
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


class Encoder:
    """Ids of texts; the ids of pieces are remembered for a bounded number of them."""

    def __init__(self, merges: Merges, lexicon: Lexicon):
        self.merges, self.lexicon = merges, lexicon
        self.cut = Cutter(merges.special)
        self.forget()

    def forget(self) -> None:
        special = self.merges.special
        self.known = _Numbered(zip(special, range(len(special))))
        self.ids = np.array(list(special.values()), dtype=np.int64)
        self.lengths = np.ones(len(special), dtype=np.int64)

    def learn(self) -> None:
        words = [p.encode("utf-8", "surrogatepass") for p in self.known.fresh]
        self.known.fresh.clear()
        places = self.lexicon.places(words)
        seen, unseen = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        ends, lengths = self.lexicon.id_ends, np.empty(len(words), dtype=np.int64)
        merged, lengths[unseen] = self.merges.encode([words[n] for n in unseen.tolist()])
        lengths[seen] = ends[places[seen] + 1] - ends[places[seen]]
        starts = np.cumsum(lengths) - lengths
        ids = np.empty(int(lengths.sum()), dtype=np.int64)
        ids[_spread(starts[unseen], lengths[unseen])] = merged
        ids[_spread(starts[seen], lengths[seen])] = self.lexicon.ids[_spread(ends[places[seen]], lengths[seen])]
        self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])

    def __call__(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        if len(self.known) > _KNOWN:
            self.forget()
        numbers, pieces = [], []
        for text in found:
            own = list(map(self.known.__getitem__, self.cut(text)))
            pieces.append(len(own))
            numbers.extend(own)
        if self.known.fresh:
            self.learn()
        numbers = np.array(numbers, dtype=np.int64)
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        starts = (np.cumsum(self.lengths) - self.lengths)[numbers]
        ids = self.ids[_spread(starts, lengths)]
        stops = np.concatenate([[0], ends])[np.cumsum(pieces)]
        return ids, np.diff(stops, prepend=0)


def piece_counts(docs: DataFrame, special: dict[str, int]) -> DataFrame:
    """(piece, n) over all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = Cutter(special), Counter()

        def flush():
            rows = [(p, n) for p, n in counts.items() if p not in special]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["piece", "n"])

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update(cut(text))
            if len(counts) > _COUNTED:
                yield flush()
        yield flush()

    found = texts(docs).select("text").mapInArrow(counted, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_lexicon(docs: DataFrame, merges: Merges, size: int = LEXICON_WORDS) -> Lexicon:
    """The most frequent pieces of at most LONGEST_WORD bytes, at most ``size``; so many words at most reach the driver.

    Frequencies are graded, and all pieces of a grade are taken or none, so no task sends a list of its own.
    """
    counts = piece_counts(docs, merges.special).where(F.octet_length("piece") <= LONGEST_WORD)
    counts = stored(counts.withColumn("grade", F.floor(F.log2("n") * 8).cast("int")), "piece_counts")
    grades = {r.grade: r["count"] for r in counts.groupBy("grade").count().collect()}  # eight for each doubling
    least, total = max(grades, default=0) + 1, 0
    for grade in sorted(grades, reverse=True):
        total += grades[grade]
        if total > size:
            break
        least = grade
    words = sorted(r.piece.encode() for r in counts.where(F.col("grade") >= least).select("piece").collect())
    return Lexicon.compile(words, *merges.encode(words))


def encode_and_decode(docs: DataFrame, tokenizer: str, *, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """One row per document: doc_id, ids (binary, little-endian unsigned 32-bit numbers), decoded (text from the ids)."""
    spark: SparkSession = docs.sparkSession
    merges = Merges.read(tokenizer)
    sent = spark.sparkContext.broadcast((vars(merges), frequent_lexicon(docs, merges, lexicon_words).tobytes()))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, data = sent.value
        merges = Merges(state)
        encode = Encoder(merges, Lexicon.mapped(data))
        for batch in slices(batches):
            ids, counts = encode(batch.column("text").to_pylist())
            spelled, packed = merges.decode(ids), ids.astype("<u4").tobytes()
            stops = np.cumsum(counts)
            bytes_of = np.concatenate([[0], np.cumsum(np.diff(merges.spelling_ends)[ids])])[stops].tolist()
            stops = (stops * 4).tolist()
            decoded = [spelled[a:b].decode("utf-8", "replace") for a, b in zip([0, *bytes_of], bytes_of)]
            packed = [packed[a:b] for a, b in zip([0, *stops], stops)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(coded, "doc_id long, ids binary, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``encode_and_decode``."""
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
