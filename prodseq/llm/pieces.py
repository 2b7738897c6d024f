"""SentencePiece encoding and decoding by vectorised merge rounds."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from prodseq.llm.batches import over_texts, texts_of
from prodseq.llm.merging import PairTable, merge

#: Distinct words whose pieces a worker remembers before it starts anew.
REMEMBERED = 300_000

#: Fixed: the visible mark of a space, and the text of an unknown piece.
SPACE_MARK, UNKNOWN_TEXT = "▁", " ⁇ "

#: Fixed: piece kinds of a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6


class PieceCodec:
    """A BPE model with byte fallback, a dummy leading space and no normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        shape = model.normalizer_spec
        if shape.precompiled_charsmap or shape.remove_extra_whitespaces or not shape.add_dummy_prefix or not model.trainer_spec.byte_fallback:
            raise ValueError("only models without normalisation, with dummy prefix and byte fallback are known")
        kinds = [p.type for p in model.pieces]
        if USER_DEFINED in kinds:
            raise ValueError("user-defined pieces are not known")
        self.size = len(kinds)
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == "</s>")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        by_score = {s: r for r, s in enumerate(sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True))}
        rank = {i: by_score[model.pieces[i].score] for i in self.ids.values()}
        rows = [
            (self.ids[piece[:k]], self.ids[piece[k:]], rank[i], i)
            for piece, i in self.ids.items()
            for k in range(1, len(piece))
            if piece[:k] in self.ids and piece[k:] in self.ids
        ]
        left, right, ranks, product = np.array(rows, np.int64).T
        self.table = PairTable.build(left, right, ranks, product, self.size)
        self.bytes = np.zeros(256, np.int32)
        told = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:-1], 16)
                self.bytes[value] = i
                told.append(bytes([value]))
            elif p.type == NORMAL:
                told.append(p.piece.replace(SPACE_MARK, " ").encode())
            else:
                told.append(UNKNOWN_TEXT.encode() if p.type == UNKNOWN else b"")
        self.told_lengths = np.array([len(t) for t in told], np.int64)
        self.told_starts = np.cumsum(self.told_lengths) - self.told_lengths
        self.told = np.frombuffer(b"".join(told), np.uint8)
        self.leading = np.array([t[:1] == b" " and k == NORMAL for t, k in zip(told, kinds, strict=True)])
        # pieces cross no line break and no space after other characters, so these end a word
        joined = [p for p in self.ids if len(p) > 1]
        if any("\n" in p or re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in joined):
            raise ValueError("pieces that cross words are not known")
        self.words = re.compile(" *[^ \n]+| +|\n")
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def learn(self, words: list[str]) -> None:
        """Merge distinct words and remember their ids, as int32 bytes and as decimal text."""
        marked = [w.replace(" ", SPACE_MARK) for w in words]
        lengths = np.array([len(w) for w in marked], np.int64)
        codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        distinct, place = np.unique(codes, return_inverse=True)
        # a character without a piece gets a number past the vocabulary, which no pair holds
        symbol = np.array([self.ids.get(chr(c), self.size + int(c)) for c in distinct], np.int32)
        flat, sizes = merge(symbol[place], lengths, _Padded(self.table, self.size))
        odd = np.flatnonzero(flat >= self.size)
        if len(odd):
            spelled = [chr(c - self.size).encode() for c in flat[odd].tolist()]
            width = np.ones(len(flat), np.int64)
            width[odd] = [len(s) for s in spelled]
            owner = np.repeat(np.arange(len(sizes)), sizes)
            longer = np.repeat(flat, width)
            longer[np.repeat(flat >= self.size, width)] = self.bytes[np.frombuffer(b"".join(spelled), np.uint8)]
            sizes = np.bincount(owner, weights=width, minlength=len(sizes)).astype(np.int64)
            flat = longer
        ends = np.cumsum(sizes).tolist()
        raw, numbers = flat.astype("<i4").tobytes(), list(map(str, flat.tolist()))
        start = 0
        for word, end in zip(words, ends, strict=True):
            self.known[word] = (raw[4 * start : 4 * end], " ".join(numbers[start:end]).encode())
            start = end

    def split(self, text: str) -> list[str]:
        """Words of a text behind its dummy space; an empty text has none."""
        return self.words.findall(" " + text.replace(SPACE_MARK, " ")) if text else []

    def encode(self, texts: list[str]) -> list[list[tuple[bytes, bytes]]]:
        """Per text its words' ids, each as int32 bytes and as decimal text, without the end id."""
        split = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        unseen = set(chain.from_iterable(split)).difference(self.known)
        if unseen:
            self.learn(list(unseen))
        return [list(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """UTF-8 texts of many id sequences laid end to end."""
        sizes = self.told_lengths[ids]
        ends = np.cumsum(lengths)
        begins = self.told_starts[ids]
        # the dummy space: the first piece of a text loses its leading space
        first = (ends - lengths)[lengths > 0]
        first = first[self.leading[ids[first]]]
        sizes[first] -= 1
        begins = begins.copy()
        begins[first] += 1
        at = np.cumsum(sizes)
        flat = self.told[np.repeat(begins - (at - sizes), sizes) + np.arange(int(at[-1]) if len(at) else 0)].tobytes()
        stops = np.concatenate([[0], at])[ends]
        return [flat[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]


class _Padded:
    """A pair table whose product marks also cover characters without a piece."""

    def __init__(self, table: PairTable, size: int):
        self.table, self.one_by_one = table, table.one_by_one

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.table.look_up(left, right)


@lru_cache(maxsize=2)
def piece_codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_and_decode(frame: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode each text with an end id and decode the ids again, one row per input row.

    Returns the id column, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; with
    ``keep_ids`` also ``ids`` and ``decoded``. A missing text counts as empty: its only id
    is the end id and it decodes to an empty text. Ids may be missing or repeated. Other
    columns of the input are not read. ``path`` names a model file every executor has.
    """

    def run(batch: pa.RecordBatch) -> dict:
        codec = piece_codec(path)
        end_raw, end_told = codec.end.to_bytes(4, "little"), str(codec.end).encode()
        rows = codec.encode(texts_of(batch, text_column))
        raw = [b"".join([*(w[0] for w in words), end_raw]) for words in rows]
        lengths = np.array([len(r) // 4 for r in raw], np.int64)
        ids = np.frombuffer(b"".join(raw), "<i4")
        decoded = codec.decode(ids, lengths)
        out = {
            "n_tokens": pa.array(lengths),
            "ids_sha256": [hashlib.sha256(b" ".join([*(w[1] for w in words), end_told])).hexdigest() for words in rows],
            "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded],
        }
        if keep_ids:
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            out["decoded"] = pa.array([d.decode("utf-8", "replace") for d in decoded])
        return out

    more = ", ids array<int>, decoded string" if keep_ids else ""
    return over_texts(frame, [id_column, text_column], run, f"n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
