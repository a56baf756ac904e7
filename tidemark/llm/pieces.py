"""Exact SentencePiece BPE encoding by backtracking over Aho-Corasick matches, and decoding."""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"
# Kinds of pieces in the model file's format
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
# Texts are cut into segments; most repeat, so their ids are remembered up to so many segments of so many characters.
_REMEMBERED, _SHORT, _PAIRS = 300_000, 48, 300_000
_NEVER = float("-inf")


class PieceModel:
    """The pieces of a BPE model file with byte fallback, and exact encoding and decoding with them."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trainer = model.normalizer_spec, model.trainer_spec
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or not plain:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no other normalization")
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.shown: list[bytes] = []
        for number, piece in enumerate(model.pieces):
            if piece.type == _NORMAL:
                self.ids[piece.piece], self.scores[piece.piece] = number, piece.score
                self.shown.append(piece.piece.replace(SPACE, " ").encode())
            elif piece.type == _BYTE:
                self.byte_ids[int(piece.piece[3:5], 16)] = number
                self.shown.append(bytes([int(piece.piece[3:5], 16)]))
            elif piece.type in (_CONTROL, _UNKNOWN):
                self.shown.append(b"" if piece.type == _CONTROL else " ⁇ ".encode())
            else:
                raise ValueError(f"{piece.piece!r} is of a kind that is not supported")
        self.begin, self.end = trainer.bos_id, trainer.eos_id
        single = {c for c in self.ids if len(c) == 1}
        if any(c not in single for piece in self.ids for c in piece):
            raise ValueError("a piece holds a character that is no piece itself")
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids):
            raise ValueError("a piece goes on after a word's end")
        # No piece crosses from another character to a space, nor holds a character unknown to the model:
        # such places are cuts of every encoding.
        known = "".join(re.escape(c) for c in sorted(single - {SPACE}))
        self.segments = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        self.runs = re.compile(f"[{SPACE}{known}]+|[^{SPACE}{known}]+").findall
        self.matches = ahocorasick.Automaton()
        for piece in self.ids:
            self.matches.add_word(piece, (len(piece) - 1, piece))
        self.matches.make_automaton()
        self.remembered = _Remembered(self)
        self.fits = functools.lru_cache(maxsize=_PAIRS)(self._fits)
        self.shorter = functools.lru_cache(maxsize=None)(self._shorter)

    def _shorter(self, piece: str) -> str | None:
        """The longest piece that is a proper prefix of the piece."""
        return next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), None)

    def merged(self, text: str) -> list[str]:
        """Plain BPE by its definition: join the best-scored neighbours, the leftmost of equals, until none joins."""
        parts, score = list(text), self.scores.get
        offers = [score(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while offers and (best := max(offers)) != _NEVER:
            at = offers.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del offers[at]
            if at < len(offers):
                offers[at] = score(parts[at] + parts[at + 1], _NEVER)
            if at:
                offers[at - 1] = score(parts[at - 1] + parts[at], _NEVER)
        return parts

    def _fits(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' characters anew ends with just these two pieces."""
        return self.merged(left + right) == [left, right]

    def split(self, segment: str) -> list[str]:
        """Pieces of a run of known characters.

        A row of pieces is the encoding if and only if every two neighbours fit. From each position the longest piece
        is tried first, then its shorter prefixes; ``open_at`` is a bitfield of the positions from which the rest has
        not failed yet, so no position fails twice.
        """
        # Matches come by their ends, so of those from one start the longest comes last.
        longest = {end - back: piece for end, (back, piece) in self.matches.iter(segment)}
        size, open_at = len(segment), (1 << (len(segment) + 1)) - 1
        fits, shorter = self.fits, self.shorter
        chosen: list[str] = []
        at = 0
        candidate: str | None = longest[0] if size else None
        while at < size:
            while candidate is not None:
                end = at + len(candidate)
                if open_at >> end & 1 and (not at or fits(chosen[-1], candidate)):
                    break
                candidate = shorter(candidate)
            if candidate is None:
                open_at &= ~(1 << at)
                last = chosen.pop()
                at -= len(last)
                candidate = shorter(last)
            else:
                chosen.append(candidate)
                at += len(candidate)
                candidate = longest.get(at)
        return chosen

    def segment_ids(self, segment: str) -> bytes:
        found = array("I")
        for run in self.runs(segment):
            if run[0] in self.ids:
                found.extend([self.ids[piece] for piece in self.split(run)])
            else:
                found.extend([self.byte_ids[b] for b in run.encode()])
        return found.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as 32-bit little-endian numbers."""
        body = b""
        if text:
            pieces = self.segments(SPACE + text.replace(" ", SPACE))
            body = b"".join(map(self.remembered.__getitem__, pieces))
        return self.begin.to_bytes(4, "little") + body + self.end.to_bytes(4, "little")

    def decode(self, ids: bytes) -> str:
        """The text of the ids: pieces joined, bytes put together, the space that encoding put in front removed."""
        shown = self.shown
        text = b"".join([shown[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _Remembered(dict):
    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, segment: str) -> bytes:
        ids = self.model.segment_ids(segment)
        if len(segment) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[segment] = ids
        return ids


@functools.lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def encode_documents(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array<int>) and decoded text of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(model_path)
        for batch in batches:
            encoded = [model.encode(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "ids": [memoryview(ids).cast("i").tolist() for ids in encoded],
                    "decoded": [model.decode(ids) for ids in encoded],
                }
            )

    narrow = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInPandas(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def token_digests(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; see ``PieceModel`` for the encoding.

    Row by row, without a shuffle: a lost task is simply run again. The model file is read on the workers from
    ``model_path``, which every machine must have. A null text counts as empty and has just the begin and end ids;
    null ids stay null; repeated rows give repeated results; very long texts are encoded whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(model_path)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = model.encode(text)
                decoded = hashlib.sha256(model.decode(ids).encode()).hexdigest()
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    # Arrow keeps null ids as they are only if the column's type can hold them: they travel as text.
    narrow = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    result = narrow.mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return result.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))
