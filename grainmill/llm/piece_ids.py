"""SentencePiece byte-pair encoding and decoding of whole texts by vectorised merge rounds.

The vocabulary file is read with its own library; texts are encoded here. A text is cut before each run of
spaces, where no piece crosses, so each distinct stretch is merged once, all new ones of a batch together.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.batches import Words, field_list, in_chunks, unused
from grainmill.llm.merges import MergeTable, ranges

SPACE = "▁"  # the mark that pieces have for a space
STRETCH = re.compile(" *[^ ]+| +")
CODE_POINTS = 0x110000


class PieceModel:
    """Encodes and decodes like the sentencepiece library does for a byte-pair model.

    Models with an identity normaliser, a leading space, byte fallback and pieces that hold spaces only at
    their start are supported; others are refused.
    """

    def __init__(self, path: str, keep: int = 450_000):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        ids = range(n)
        pieces = [library.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        bytes_at = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        probe = "　Ａ  ﬁ \x00é "
        if not all(map(library.is_byte, bytes_at)) or any(map(library.is_unused, ids)):
            raise ValueError("the model has no byte fallback, or unused pieces")
        if any(re.search(f"[^{SPACE}]{SPACE}", pieces[i]) for i in plain) or library.decode(library.encode(probe)) != probe:
            raise ValueError("the model's pieces hold spaces inside, or its normaliser changes texts")
        self.n, self.keep, self.bos, self.eos = n, keep, library.bos_id(), library.eos_id()
        at = {pieces[i]: i for i in plain}
        # A character without a piece is the number n + code point; it merges where a longer piece holds it.
        self.symbol_of = np.arange(n, n + CODE_POINTS, dtype=np.int64)
        for piece, i in at.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        self.symbol_of[ord(" ")] = self.symbol_of[ord(SPACE)]

        def symbol(piece):
            return self.symbol_of[ord(piece)] if len(piece) == 1 else at.get(piece)

        scores = {i: library.get_score(i) for i in plain}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rows = [
            (symbol(p[:k]), symbol(p[k:]), i, order[scores[i]])
            for p, i in at.items()
            for k in range(1, len(p))
            if symbol(p[:k]) is not None and symbol(p[k:]) is not None
        ]
        self.table = MergeTable(*np.array(rows, np.int64).T, n + CODE_POINTS)
        self.byte_ids = np.array(bytes_at, np.int32)
        self.raw = [p.replace(SPACE, " ").encode() for p in pieces]
        for i in ids:
            if library.is_control(i):
                self.raw[i] = b""
            elif library.is_unknown(i):
                self.raw[i] = library.decode([i]).encode()
        for b, i in enumerate(bytes_at):
            self.raw[i] = bytes([b])
        self.raw_sizes = np.array([len(x) for x in self.raw], np.int64)
        self.spaced = np.zeros(n, bool)
        self.spaced[[i for i in plain if pieces[i].startswith(SPACE)]] = True
        self.is_byte = np.zeros(n, bool)
        self.is_byte[bytes_at] = True
        self._forget()

    def _forget(self) -> None:
        self.stretches = Words()
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _fall_back(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        unknown = symbols >= self.n
        if not unknown.any():
            return symbols, sizes
        raw = symbols[unknown].astype("<u4") - self.n
        raw = np.frombuffer(raw.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        points = symbols[unknown] - self.n
        each = np.ones(len(symbols), np.int64)
        each[unknown] = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        out = np.repeat(symbols, each)
        out[np.repeat(unknown, each)] = self.byte_ids[raw]
        upto = np.append(0, np.cumsum(each))
        ends = np.cumsum(sizes)
        return out, upto[ends] - upto[ends - sizes]

    def _learn(self) -> None:
        fresh, self.stretches.fresh = self.stretches.fresh, []
        lengths = np.fromiter(map(len, fresh), np.int64, len(fresh))
        points = np.frombuffer("".join(fresh).encode("utf-32-le"), "<u4")
        ids, sizes = self._fall_back(*self.table.merge(self.symbol_of[points], lengths))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of `texts` with begin and end ids, end to end, and the number of ids of each."""
        if len(self.stretches) > self.keep:
            self._forget()
        codes = []
        for text in texts:
            found = STRETCH.findall(" " + text.replace(SPACE, " ")) if text else []
            codes.append(np.fromiter(map(self.stretches.__getitem__, found), np.int64, len(found)))
        if self.stretches.fresh:
            self._learn()
        counts = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        ids = self.ids[ranges(self.starts[flat], self.sizes[flat])]
        upto = np.append(0, np.cumsum(self.sizes[flat]))
        ends = np.cumsum(counts)
        first, last = upto[ends - counts], upto[ends]
        at = np.stack((first, last), axis=1).ravel()
        return np.insert(ids, at, np.tile([self.bos, self.eos], len(texts))), last - first + 2

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of ids that lie end to end: bytes are read as UTF-8 (each byte that is none becomes U+FFFD), one leading space goes."""
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        upto = np.append(0, np.cumsum(self.raw_sizes[ids]))
        ends = np.cumsum(sizes)
        texts = []
        for a, b in zip((ends - sizes).tolist(), ends.tolist()):
            try:
                text = raw[upto[a] : upto[b]].decode()
                if (self.raw_sizes[ids[a + 1 : b - 1]] == 0).any():  # a control id between bytes parts them
                    text = self._mended(ids[a:b])
            except UnicodeDecodeError:
                text = self._mended(ids[a:b])
            bare = ids[a:b][self.raw_sizes[ids[a:b]] > 0]
            texts.append(text[1:] if len(bare) and self.spaced[bare[0]] else text)
        return texts

    def _mended(self, ids: np.ndarray) -> str:
        """The text of ids whose bytes are not all UTF-8."""
        out, held = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                held += self.raw[i]
                continue
            while held:
                for n in range(min(4, len(held)), 0, -1):
                    try:
                        out.append(held[:n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                held = held[n:]
            if i is not None:
                out.append(self.raw[i].decode())
        return "".join(out)


@functools.lru_cache(2)
def piece_model(path: str) -> PieceModel:
    """The model of this process: what one task has learnt, the next one of the same worker knows."""
    return PieceModel(path)


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """The columns of `docs` but the text, with `ids` (little-endian unsigned 32-bit numbers, begin and end ids
    included) and, if `decoded`, the text that decoding these ids gives. A null or empty text has the begin and
    end id and decodes to an empty text. Whole texts are encoded. Columns named like the new ones are replaced.
    """
    added = ["ids", *["decoded"] * decoded]
    others = docs.drop(text_col, *added)
    rows = docs.select(*[F.col(f"`{c}`") for c in others.columns], F.col(f"`{text_col}`").alias(unused(docs, "text")))
    names = [*others.columns, *added]
    schema = field_list(others.schema) + ", ids binary" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            texts = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
            for part in in_chunks(texts):
                ids, sizes = pieces.encode(texts[part])
                raw = ids.astype("<u4").tobytes()
                cuts = (np.append(0, np.cumsum(sizes)) * 4).tolist()
                columns = [c.slice(part.start, part.stop - part.start) for c in batch.columns[:-1]]
                columns.append(pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()))
                if decoded:
                    columns.append(pa.array(pieces.decode(ids, sizes), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def decode_pieces(df: DataFrame, model: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """The columns of `df` with the text of each row's ids (as `encode_pieces` gives them); null ids decode to an empty text."""
    kept = df.drop(into)
    at = kept.columns.index(ids_col)

    def run(batches):
        pieces = piece_model(model)
        for batch in batches:
            raw = [x or b"" for x in batch.column(at).to_pylist()]
            sizes = np.fromiter((len(x) // 4 for x in raw), np.int64, len(raw))
            ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
            yield batch.append_column(into, pa.array(pieces.decode(ids, sizes), pa.string()))

    return kept.mapInArrow(run, f"{field_list(kept.schema)}, `{into}` string")
