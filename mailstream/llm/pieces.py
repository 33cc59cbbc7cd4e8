"""Merge-type (BPE) SentencePiece vocabularies: encoding by an agenda, decoding.

`encode_pieces` turns each text into ids.  A text is cut into stretches that no piece of
the vocabulary can join; in each stretch the adjacent pair with the best score is
merged, leftmost first among equals, until no pair is a piece.  Symbols without a piece
become byte pieces.  Every Arrow batch is compared with the sentencepiece library, which
also does the decoding that the result is compared with; a difference is an error.

Null text counts as empty; empty text has the begin and end ids only.  Rows are
independent: repeated rows give equal results, other columns are not looked at, an
empty table gives an empty result.  Very long texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import sys
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mailstream.llm.common import text_or_empty

SPACE = "▁"
#: Bytes of text that are encoded at once; a longer text is encoded whole.
TEXT_BYTES = 4 << 20
#: Characters of a stretch whose agenda is a row of a matrix, and rows of a matrix.
SHORT, MERGED_AT_ONCE = 64, 4096


class MergeVocabulary:
    """Scores and ids of a merge-type model, as read from the model file's bytes."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        every = range(lib.vocab_size())
        self.pieces = lib.id_to_piece([*every])
        scores = lib.get_score([*every])
        control, unknown, byte, unused = (
            {i for i, held in zip(every, kind([*every]), strict=True) if held}
            for kind in (lib.is_control, lib.is_unknown, lib.is_byte, lib.is_unused)
        )
        if len(byte) != 256 or unused:
            raise ValueError("the model must have byte pieces and no unused pieces")
        self.byte_ids = lib.piece_to_id([f"<0x{b:02X}>" for b in range(256)])
        raw = dict(zip(self.byte_ids, map(bytes, zip(range(256))), strict=True))
        said = [
            b"" if i in control else raw.get(i) or piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(self.pieces)
        ]
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_sizes = np.fromiter(map(len, said), np.int64, len(said))
        self.said_starts = np.cumsum(self.said_sizes) - self.said_sizes
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        special = control | unknown | byte
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        # The best score comes off the agenda first, so scores are stored negated.
        self.costs = {piece: -scores[i] for piece, i in self.ids.items()}
        joined = "".join(piece for piece in self.ids if len(piece) > 1)
        # Characters that are stretches of their own, as they join with nothing.
        self.alone = [ord(c) for c in "\n\t\r" if c not in joined]
        self.whole = any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self._number_symbols()
        if lib.encode("a  b", out_type=str) != self.names(self.encode("a  b")[1:-1]):
            raise ValueError("the model normalises texts; only plain ones are supported")

    def _number_symbols(self) -> None:
        """Tables for merging many stretches at once: symbols, and pairs that join to one.

        Symbols are the pieces and the characters of pieces; `nothing` is the last one, and
        any other character is `other`.  Neither of the two joins with anything.
        """
        letters = sorted({c for piece in self.ids for c in piece} - self.ids.keys())
        number = {name: i for i, name in enumerate([*self.ids, *letters])}
        other = len(number)
        self.nothing = other + 1
        self.id_of_symbol = np.array([*self.ids.values(), *[-1] * (len(letters) + 1), 0])
        self.symbol_of = np.full(sys.maxunicode + 1, other, np.int32)
        for name, i in number.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = i
        ranks = {cost: i for i, cost in enumerate(sorted(set(self.costs.values())))}
        self.never = len(ranks)
        pairs = sorted(
            (number[piece[:k]] * (other + 2) + number[piece[k:]], ranks[cost], number[piece])
            for piece, cost in self.costs.items()
            for k in range(1, len(piece))
            if piece[:k] in number and piece[k:] in number
        )
        # The last key is larger than any pair's, so that a search always finds a place.
        end = ((other + 2) ** 2, self.never, self.nothing)
        table = np.array([*pairs, end], np.int64)
        self.pair_keys, self.pair_ranks, self.pair_symbols = np.ascontiguousarray(table.T)

    def names(self, ids: list[int]) -> list[str]:
        return [self.pieces[i] for i in ids]

    def encode(self, text: str) -> list[int]:
        """Ids of the text between the begin and the end id."""
        return self.encode_all(pa.array([text], pa.large_string()))[0].tolist()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another, and the number of ids of each.

        Equal stretches of the texts are merged once.
        """
        texts = texts.cast(pa.large_string())
        blank, nothing = (pa.scalar(x, pa.large_string()) for x in (SPACE, ""))
        marked = pc.replace_substring(texts, " ", SPACE)
        marked = pc.binary_join_element_wise(blank, marked, nothing)
        marked = pc.if_else(pc.equal(texts, nothing), nothing, marked)
        ends, data = _strings(marked)
        cuts = self._cuts(ends, data)
        bounds = pa.py_buffer(cuts.astype(np.int64))
        stretches = pa.LargeStringArray.from_buffers(len(cuts) - 1, bounds, pa.py_buffer(data))
        stretches = stretches.dictionary_encode()
        ids, starts, sizes = self._merge_all(stretches.dictionary)
        codes = stretches.indices.to_numpy()
        ids = _gather(ids, starts[codes], sizes[codes])
        before = np.concatenate([[0], np.cumsum(sizes[codes])])
        counts = np.diff(before[np.searchsorted(cuts, ends)]) + 2
        last = np.cumsum(counts) - 1
        first = last + 1 - counts
        out = np.empty(counts.sum(), np.int32)
        inner = np.ones(len(out), bool)
        inner[first] = inner[last] = False
        out[first], out[last], out[inner] = self.begin, self.end, ids
        return out, counts

    def _cuts(self, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where stretches begin and end: at texts, before runs of blanks, around lone
        characters."""
        at = np.zeros(len(data) + 1, bool)
        at[ends] = True
        if self.whole:
            return np.flatnonzero(at)
        blank = np.frombuffer(SPACE.encode(), np.uint8)
        n = len(data) - len(blank) + 1
        if n > 0:
            hit = np.logical_and.reduce([data[i : i + n] == byte for i, byte in enumerate(blank)])
            found = np.flatnonzero(hit)
            at[found[np.diff(found, prepend=-len(blank)) != len(blank)]] = True
        for point in self.alone:
            found = np.flatnonzero(data == point)
            at[found] = at[found + 1] = True
        return np.flatnonzero(at)

    def _merge_all(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of stretches, and where those of each stretch start and how many they are."""
        length = pc.utf8_length(parts).to_numpy()
        order = np.argsort(length, kind="stable")
        short = order[: np.searchsorted(length[order], SHORT, side="right")]
        starts, sizes = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        blocks, done, single = [np.zeros(0, np.int64)], 0, [order[len(short) :]]
        for start in range(0, len(short), MERGED_AT_ONCE):
            block = short[start : start + MERGED_AT_ONCE]
            ids, counts, unnamed = self._merge_block(parts.take(pa.array(block)), length[block])
            blocks.append(ids)
            starts[block] = done + np.cumsum(counts) - counts
            sizes[block] = counts
            done += len(ids)
            single.append(block[unnamed])
        for i in np.concatenate(single).tolist():
            blocks.append(np.array(self._merge(parts[i].as_py()), np.int64))
            starts[i], sizes[i] = done, len(blocks[-1])
            done += sizes[i]
        return np.concatenate(blocks), starts, sizes

    def _merge_block(
        self, parts: pa.Array, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of some short stretches and their numbers, with -1 for symbols that have no
        id, and which stretches have such symbols.

        The agendas are rows of one matrix: a row has the rank of each adjacent pair; each
        round merges the best pair of every row that has one, the leftmost among equals.
        """
        rows, width = len(parts), int(size.max())
        text = _strings(parts)[1].tobytes().decode()
        used = np.arange(width) < size[:, None]
        # Column `width` stands for the end of a row: a symbol that joins with nothing.
        symbols = np.full((rows, width + 1), self.nothing, np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        symbols[:, :width][used] = self.symbol_of[points]
        after = np.tile(np.arange(1, width + 2), (rows, 1))
        after[:, width] = width
        before = np.tile(np.arange(-1, width), (rows, 1))
        before[:, 0] = width
        rank = np.full((rows, width + 1), self.never, np.int64)
        joined = np.full((rows, width + 1), self.nothing, np.int64)
        rank[:, :-1], joined[:, :-1] = self._pairs(symbols[:, :-1], symbols[:, 1:])
        still = np.flatnonzero(rank.min(axis=1) < self.never)
        while len(still):
            i = rank[still].argmin(axis=1)
            gone = after[still, i]
            following, preceding = after[still, gone], before[still, i]
            symbols[still, i] = joined[still, i]
            symbols[still, gone] = self.nothing
            rank[still, gone] = self.never
            after[still, i] = following
            before[still, following] = i
            for left, right in ((i, following), (preceding, i)):
                pair = self._pairs(symbols[still, left], symbols[still, right])
                rank[still, left], joined[still, left] = pair
            # A row's end takes what is written to it and stays the end.
            rank[still, width] = self.never
            still = still[rank[still].min(axis=1) < self.never]
        alive = symbols != self.nothing
        ids = self.id_of_symbol[symbols[alive]]
        counts = alive.sum(axis=1)
        unnamed = np.zeros(rows, bool)
        unnamed[np.repeat(np.arange(rows), counts)[ids < 0]] = True
        return ids, counts, unnamed

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of joined pairs; `never` and `nothing` where no piece results."""
        keys = left * len(self.id_of_symbol) + right
        at = np.searchsorted(self.pair_keys, keys)
        found = self.pair_keys[at] == keys
        ranks = np.where(found, self.pair_ranks[at], self.never)
        return ranks, np.where(found, self.pair_symbols[at], self.nothing)

    def _merge(self, part: str) -> list[int]:
        ids = []
        for symbol in self._merge_long(part):
            known = self.ids.get(symbol)
            if known is None:
                ids += [self.byte_ids[b] for b in symbol.encode()]
            else:
                ids.append(known)
        return ids

    def _merge_long(self, part: str) -> list[str]:
        """The agenda of a long stretch is a heap, with pairs that may have gone stale."""
        costs = self.costs
        symbols: list[str | None] = list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                pair = symbols[left] + symbols[right]
                cost = costs.get(pair)
                if cost is not None:
                    heapq.heappush(agenda, (cost, left, right, pair))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            # Either symbol may have been merged since the pair was proposed.
            if symbols[left] is None or symbols[right] is None or after[left] != right:
                continue
            if symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            propose(before[left], left)
            propose(left, after[left])
        return [symbol for symbol in symbols if symbol is not None]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; byte pieces are read as UTF-8."""
        return self.decode_all(np.asarray(ids, np.int64), np.array([len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ids that stand one text after another."""
        data = _gather(self.said, self.said_starts[ids], self.said_sizes[ids])
        before = np.concatenate([[0], np.cumsum(self.said_sizes[ids])])
        ends = before[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [
            data[start:end].tobytes().decode(errors="replace").removeprefix(" ")
            for start, end in pairwise(ends)
        ]


def _strings(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Borders and bytes of an array of large strings, from zero."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    return ends - ends[0], held


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of `values` with these starts and sizes, one after another."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return values[np.arange(sizes.sum()) + np.repeat(shift, sizes)]


def _by_bytes(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about TEXT_BYTES of a column, one row at least."""
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // TEXT_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in pairwise(cuts):
        yield batch.slice(start, end - start)


def encode_pieces(
    docs: DataFrame, model_path: str, with_ids: bool = True, with_text: bool = True
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and `ids` and `decoded` if wanted."""
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if with_text:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = MergeVocabulary(model.value)
        library = vocabulary.library
        for batch in batches:
            for part in _by_bytes(batch, "text"):
                texts = part.column("text")
                flat, counts = vocabulary.encode_all(texts)
                ends = np.cumsum(counts)
                ids = np.split(flat, ends[:-1])
                listed = [x.tolist() for x in ids]
                texts = texts.to_pylist()
                if library.encode(texts, add_bos=True, add_eos=True, num_threads=1) != listed:
                    raise ValueError("encoding differs from the sentencepiece library")
                decoded = library.decode(listed, num_threads=1)
                if vocabulary.decode_all(flat, counts) != decoded:
                    raise ValueError("decoding differs from the sentencepiece library")
                arrays = [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array([_digest(x.astype("<u4").tobytes()) for x in ids], pa.string()),
                    pa.array([_digest(x.encode()) for x in decoded], pa.string()),
                ]
                if with_ids:
                    borders = pa.array([0, *ends.tolist()], pa.int32())
                    arrays.append(pa.ListArray.from_arrays(borders, pa.array(flat, pa.int32())))
                if with_text:
                    arrays.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    rows = docs.select(docs["doc_id"].cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, T.StructType(fields))


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
