"""Packing of tokenised documents into windows by best-fit decreasing.

A document longer than a window is cut into full windows and a rest. What is packed
then are pieces of 1 to ``WINDOW`` tokens, and pieces of one length are alike: the plan
needs only how many there are of each. It goes from long to short and puts whole runs
of equal pieces into runs of windows with the same room, so it has a bounded number of
steps whatever the corpus; a segment tree over the remaining room finds the tightest
open windows. Spark counts the lengths, numbers the pieces of each and looks the
numbers up in the plan.

A null or empty text is the end sign alone. Rows with a null doc_id and repeated rows
are packed like others. An empty table gives an empty result. Extra columns of pieces
pass through ``pack``.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.tables import keep

WINDOW = 2048
END = 1
# Groups that the pieces of one length are numbered in side by side.
SALTS = 256
# Chunks a worker process remembers, half of them from its last turn; bounds memory, never results.
KNOWN_CHUNKS = 300_000
# Text of one step of a task, in bytes; bounds memory, never results.
STEP_BYTES = 4 << 20
_SPACE = re.compile(rb"[\t-\r ]")
# Small Latin letters: nothing but merges applies to a word of them.
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")


# Byte values as the tokenizer's vocabulary writes them: printable ones as they are, the rest from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_REST = [b for b in range(256) if b not in _PRINTABLE]
_BYTES = {b: chr(256 + i) for i, b in enumerate(_REST) if b != ord(" ")}

# Kinds of bytes. Others are those of signs beyond ASCII, control signs, and | for its part in control tokens.
_BLANK, _LETTER, _DIGIT, _SIGN, _APOSTROPHE, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[ord("'")], _KIND[ord("|")] = _APOSTROPHE, _OTHER
_KIND[[*range(9, 14), 32]] = _BLANK
# Whether a byte of the second kind starts a chunk after one of the first, at 8 * first + second.
_STARTS = np.zeros((8, 8), bool)
_STARTS[_BLANK, 1:] = True
_STARTS[_LETTER, [_DIGIT, _SIGN, _APOSTROPHE]] = True
_STARTS[_DIGIT, [_LETTER, _DIGIT, _SIGN, _APOSTROPHE]] = True
_STARTS[_SIGN, [_LETTER, _DIGIT]] = True
_STARTS[_APOSTROPHE, _DIGIT] = True
_STARTS = _STARTS.ravel()
_TOKENS: dict[str, Tokens] = {}


def _fold(text: str) -> str:
    """Lower case, as the tokenizer would, where that cannot interfere with its other steps."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text if "<|" in text else text.lower()


def _fold_bytes(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """``_fold`` of what lies between ``heads`` in ``data``, as UTF-8."""
    lower = np.frombuffer(data.tobytes().lower(), np.uint8).copy()
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] <= 0x9E) & (data[after] != 0x97)]
    lower[after] += 0x20
    # From C4 on bytes lead signs beyond Latin-1.
    odd = data >= 0xC4
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    ends = np.concatenate([[0], heads, [len(data)]])
    for text in np.unique(np.searchsorted(ends, np.flatnonzero(odd), "right") - 1).tolist():
        lower[ends[text] : ends[text + 1]] = data[ends[text] : ends[text + 1]]
    return lower


def _chunks(data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The chunks of ``data`` in order, as numbers; how many come before each of ``heads``; the chunk of each number.

    Chunks are parted by heads, by white space and, between two signs of ASCII, wherever the
    tokenizer parts a text for certain: around digits, and between letters and other signs.
    A letter stays with an apostrophe before it, and control tokens stay whole.
    """
    kind = np.frombuffer(data.tobytes().translate(_KIND.tobytes()), np.uint8).copy()
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    kind[after[(data[after] != 0x97) & (data[after] != 0xB7)]] = _LETTER
    shown = kind != _BLANK
    first = shown.copy()
    first[1:] = _STARTS[(kind[:-1] << 3) + kind[1:]]
    first[heads] = shown[heads]
    body = _fold_bytes(data, heads)[shown]
    starts = np.append(np.flatnonzero(first[shown]), len(body))
    chunks = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(body)])
    coded = chunks.dictionary_encode()
    before = np.searchsorted(np.flatnonzero(first), heads)
    # Chunks hold no white space; one split is faster than single values.
    _, offsets, signs = coded.dictionary.buffers()
    offsets = np.frombuffer(offsets, np.int64)[: len(coded.dictionary) + 1]
    joined = np.insert(np.frombuffer(signs or b"", np.uint8)[: offsets[-1]], offsets[1:-1], ord(" ")).tobytes().decode()
    return coded.indices.to_numpy(), before, joined.split(" ") if joined else []


class Tokens:
    """Token ids of texts as bytes; equal chunks are encoded once.

    The tokenizer never lets a token cross the ends of chunks, so a text's ids are those of
    its chunks in order. A chunk that is one plain word takes the vocabulary's merges alone;
    anything else goes through the whole tokenizer. All this holds for tokenizers that part
    and lower-case like ``word_bpe_49k.json`` and mark the ends of words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._plain = Tokenizer(self._tokenizer.model)
        self._plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        mark = self._tokenizer.model.end_of_word_suffix
        vocabulary = self._tokenizer.get_vocab()
        self._last = np.zeros(max(vocabulary.values()) + 1, bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    @staticmethod
    def shared(path: str) -> Tokens:
        """One per worker process, so that tasks after each other learn from the ones before."""
        if path not in _TOKENS:
            _TOKENS[path] = Tokens(path)
        return _TOKENS[path]

    def _merges(self, words: list[str]) -> list[bytes]:
        """Ids of plain words. No other token than a word's last ends in the vocabulary's end mark."""
        groups = [" ".join(words[i : i + 64]).lower() for i in range(0, len(words), 64)]
        groups = [g if g.isascii() else g.encode().decode("latin-1").translate(_BYTES) for g in groups]
        ids = array("I")
        for found in self._plain.encode_batch_fast(groups, add_special_tokens=False):
            ids.extend(found.ids)
        raw = ids.tobytes()
        ends = (4 * np.flatnonzero(self._last[np.frombuffer(raw, "<u4")]) + 4).tolist()
        return [raw[start:end] for start, end in zip([0, *ends], ends)]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        # What was not met since the last turn is forgotten; frequent chunks stay.
        if len(self._known) > KNOWN_CHUNKS // 2:
            self._older, self._known = self._known, {}
        known, older, plain, other = self._known, self._older, [], []
        for chunk in [c for c in chunks if c not in known]:
            if (ids := older.get(chunk)) is not None:
                known[chunk] = ids
            elif chunk.isascii() and chunk.isalpha() or _PLAIN.fullmatch(_fold(chunk)):
                plain.append(chunk)
            else:
                other.append(chunk)
        known.update(zip(plain, self._merges(plain), strict=True))
        for chunk, found in zip(other, self._tokenizer.encode_batch(other, add_special_tokens=False)):
            known[chunk] = array("I", found.ids).tobytes()
        return list(map(known.__getitem__, chunks))

    def of(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        cuts, parts, start, total = np.zeros(len(ends), np.int64), [], 0, 0
        while start < len(data):
            # Up to white space or the end of a text.
            stop = min(start + STEP_BYTES, len(data))
            stop = min(m.end() if (m := _SPACE.search(data, stop)) else len(data), int(ends[np.searchsorted(ends, stop)]))
            heads = slice(*np.searchsorted(ends, [start, stop]))
            which, before, chunks = _chunks(data[start:stop], ends[heads] - start)
            found = self._ids(chunks)
            pool = np.frombuffer(b"".join(found), "<u4")
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            each = sizes[which]
            at = np.append(0, np.cumsum(each))
            parts.append(pool[np.repeat((np.cumsum(sizes) - sizes)[which] - at[:-1], each) + np.arange(at[-1])].tobytes())
            cuts[heads] = total + 4 * at[before]
            start, total = stop, total + len(parts[-1])
        cuts[np.searchsorted(ends, start) :] = total
        ids, cuts = b"".join(parts), cuts.tolist()
        return [ids[start:end] for start, end in zip(cuts, cuts[1:])]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, cut where the texts before a row fill another ``STEP_BYTES``."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64)
        cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // STEP_BYTES)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(start, end - start)


def tokenize(docs: DataFrame, path: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens[, ids])``; lengths are 1 to ``window``."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    end = array("I", [END]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens.shared(path)
        for batch in _steps(batches):
            out = [[] for _ in range(5)]
            ids = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), tokens.of(batch.column("text"))):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, window):
                    piece = raw[4 * start : 4 * (start + window)]
                    for column, value in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), total)):
                        column.append(value)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<i4"))
            columns = [pa.array(c, pa.int64()) for c in out]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)


class RoomTree:
    """Segment tree over remaining room; a leaf counts the open runs of windows with that room."""

    def __init__(self, window: int):
        self._size = 1 << window.bit_length()
        self._tree = [0] * (2 * self._size)

    def add(self, room: int, change: int) -> None:
        node = room + self._size
        while node:
            self._tree[node] += change
            node //= 2

    def tightest(self, length: int) -> int | None:
        """The least room of ``length`` or more that is open."""
        node = length + self._size
        if self._tree[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self._tree[node + 1]:
                node += 1
                while node < self._size:
                    node = 2 * node if self._tree[2 * node] else 2 * node + 1
                return node - self._size
            node //= 2
        return None


def plan(counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows ``(length, first piece, pieces, first sequence, offset)`` for ``counts[length]`` pieces.

    The pieces of a length from the first on go one each into the sequences from the first on.
    """
    tree, runs, out, opened = RoomTree(window), [[] for _ in range(window + 1)], [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            runs[room].append((first, n))
            tree.add(room, 1)

    for length in range(window, 0, -1):
        at, left = 0, int(counts[length])
        while left and (room := tree.tightest(length)) is not None:
            first, n = runs[room].pop()
            tree.add(room, -1)
            used = min(left, n)
            out.append((length, at, used, first, window - room))
            put(room - length, first, used)
            put(room, first + used, n - used)
            at, left = at + used, left - used
        each = window // length
        for windows, pieces in ((left // each, each), (1, left % each)):
            if windows and pieces:
                for i in range(pieces):
                    out.append((length, at, windows, opened, i * length))
                    at += windows
                put(window - pieces * length, opened, windows)
                opened += windows
    return np.array(out, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. The input is read twice: keep it first."""
    salt = F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS)).cast("int")
    counted = pieces.groupBy("length", salt.alias("salt")).count().toArrow()
    table = np.zeros((window + 1, SALTS), np.int64)
    table[counted.column("length").to_numpy(), counted.column("salt").to_numpy()] = counted.column("count").to_numpy()
    steps = plan(table.sum(1), window)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    shared = pieces.sparkSession.sparkContext.broadcast((table.cumsum(1) - table, steps))
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, steps = shared.value
        keys = (steps[:, 0] << 48) + steps[:, 1]
        for batch in batches:
            length, salt = (batch.column(c).to_numpy() for c in ("length", "_salt"))
            rank = before[length, salt] + batch.column("_rank").to_numpy() - 1
            step = steps[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(step[:, 3] + rank - step[:, 1]), pa.array(step[:, 4])],
                [*names, "sequence_id", "offset"],
            )

    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")
    numbered = pieces.withColumn("_salt", salt).withColumn("_rank", F.row_number().over(order).cast("bigint"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return numbered.mapInArrow(place, kinds + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """Every piece of ``docs`` with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(keep(tokenize(docs, path, window)), window)


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """``(sequence_id, length, ids)`` from packed pieces with ids: padded to the window,
    except at a power of two. A sequence has at most ``window`` tokens, so groups are small."""
    whole = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    power = F.expr("length & (length - 1)") == 0
    filled = F.when(power, F.array().cast("array<int>")).otherwise(F.array_repeat(F.lit(pad), (window - F.col("length")).cast("int")))
    return whole.select("sequence_id", "length", F.concat(F.flatten(F.expr("transform(parts, x -> x.ids)")), filled).alias("ids"))
