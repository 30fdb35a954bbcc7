"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled from a .model file, three machines are composed with each text:

* the normaliser: dummy prefix, white space escape, optional removal of extra white space;
* the pieces: one arc per piece whose characters come next, weighted with minus the piece's score, and byte fallback
  arcs for a character that no piece spells;
* for a BPE model, an acceptor of piece pairs. It lets a piece follow another only if merging their joined text by the
  model's ranks gives back those two pieces. A sequence whose neighbours all pass is the one that merging the whole text
  gives: the first merge across a border would also have been made in the two pieces alone. So one path is left, and it
  is the library's result. A unigram model has no such acceptor.

The path is the shortest one in the tropical semiring (costs add along a path, the least one wins; of equal costs the
path whose last piece starts first), found left to right in time linear in the text. At each end the arcs that lead there are
tried from the shortest; under an acceptor of piece pairs the first one let through is the only one. Where no piece holds two neighbouring
characters, every path runs through the state between them and nothing before it matters after it. The stretches between
such cuts (words, their end signs, ...) are solved once each and remembered.

Defined results: a null text gives null ids, an empty one no ids; the escape character itself reads as a space; ids of
unknown text without byte fallback are the unknown id. Decoding gives back the normalised text.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator
from operator import add
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stayline.llm.common import Memo, Recent, documents, kept_alone, list_array, slices
from stayline.llm.registry import query
from stayline.llm.token_files import vocabulary_path

# Fixed values of the model format
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0

STOP = object()


class Pairs(dict):
    """What ``make`` gives for a pair of pieces, as ``self[left][right]``; starts afresh when ``limit`` pairs are held.

    A table per left piece needs no object per pair, and each piece's text is held once.
    """

    def __init__(self, make: Callable[[str, str], bool], limit: int):
        super().__init__()
        self.make, self.limit, self.held = make, limit, 0

    def __missing__(self, left: str) -> Followers:
        found = self[sys.intern(left)] = Followers(self, left)
        return found

    def __iter__(self) -> Iterator[tuple[str, str]]:
        return ((left, right) for left, own in self.items() for right in own)


class Followers(dict):
    """Which pieces may follow ``left``."""

    def __init__(self, pairs: Pairs, left: str):
        super().__init__()
        self.pairs, self.left = pairs, left

    def __missing__(self, right: str) -> bool:
        if self.pairs.held >= self.pairs.limit:
            self.pairs.clear()
            self.pairs.held = 0
        found = self[sys.intern(right)] = self.pairs.make(self.left, right)
        self.pairs.held += 1
        return found


class PieceTransducer:
    """Pieces, ranks and settings of one model; see the module's text."""

    def __init__(self, path: str, memory: int = 500_000, stretches: int | None = None):
        from sentencepiece import sentencepiece_model_pb2 as format_

        model = format_.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kind = model.normalizer_spec, model.trainer_spec.model_type
        if norm.precompiled_charsmap or kind not in (UNIGRAM, BPE) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only identity character maps, unigram or BPE models and white space as prefix are compiled")
        self.prefix, self.shrink = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.spelled = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)}
        self.scores = [p.score for p in model.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.out = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
                    else b"" if p.type == CONTROL
                    else " ⁇ ".encode() if p.type == UNKNOWN
                    else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        self.merges = kind == BPE
        # arcs: what leads to a state; None where characters only end a piece
        self.arcs: dict[str, float | None] = {p[n:]: None for p in self.spelled for n in range(1, len(p))}
        self.arcs.update((p, -self.scores[i]) for p, i in self.spelled.items())
        self.longest = max(map(len, self.spelled), default=1)
        self.beyond = min(self.scores[i] for i in self.spelled.values()) - UNKNOWN_PENALTY if self.spelled else 0.0
        # neighbouring characters that some piece holds; between others every path passes a state of its own
        self.joined = {p[i:i + 2] for p in self.spelled for i in range(len(p) - 1)}
        self.cuts_at_space = not any(pair[1] == SPACE != pair[0] for pair in self.joined)
        self.pairs = Pairs(self._may_follow, memory)
        self.halves, self.ordered = Memo(self._halves, memory), Memo(self._in_order, memory)
        self.stable = Memo(lambda piece: len(piece) == 1 or self._merged(piece) == [piece], memory)
        # most stretches come once: a bound of its own keeps the frequent ones in less memory, for more computing
        self.solved = Memo(self._solve, 2 * memory) if stretches is None else Recent(self._solve, stretches)
        self.stretch = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    # ---- normaliser

    def normalise(self, text: str) -> str:
        if self.shrink:
            text = " ".join(w for w in text.split(" ") if w)
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    # ---- acceptor of piece pairs

    def _merged(self, text: str, down_to: int = 1) -> list[str]:
        """Merge neighbours by rank, highest score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > down_to:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.spelled.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes this one, or None when merging does not lead to it."""
        if len(piece) < 2 or piece not in self.spelled:
            return None
        for i in range(1, len(piece)):
            left, right = piece[:i], piece[i:]
            if ((len(left) == 1 or left in self.spelled) and (len(right) == 1 or right in self.spelled)
                    and self._merged(left) == [left] and self._merged(right) == [right]
                    and self._merged(piece, 2) == [left, right]):
                return left, right
        return None

    def _in_order(self, piece: str) -> bool:
        """Every merge inside the piece has a better score than the merge it goes into."""
        if len(piece) == 1:
            return True
        halves = self.halves[piece]
        score = self.scores[self.spelled[piece]] if halves else 0.0
        return halves is not None and all(
            len(h) == 1 or self.scores[self.spelled[h]] > score and self.ordered[h] for h in halves)

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether no merge crosses the border of the two pieces.

        Merges are taken back, the latest first; what then stands at the border must not have merged before the merge
        just taken back. Of equal scores the one further left comes first. Pieces whose merges are not in order of
        score are merged out instead.
        """
        if not (self.stable[left] and self.stable[right]):
            return False
        if not (self.ordered[left] and self.ordered[right]):
            return self._merged(left + right) == [left, right]
        spelled, scores = self.spelled, self.scores
        until, ties = -float("inf"), False
        while True:
            found = spelled.get(left + right)
            if found is not None and (scores[found] > until or ties and scores[found] == until):
                return False
            a = scores[spelled[left]] if len(left) > 1 else float("inf")
            b = scores[spelled[right]] if len(right) > 1 else float("inf")
            if a == b == float("inf"):
                return True
            if a < b:
                until, ties, left = a, False, self.halves[left][1]
            else:
                until, ties, right = b, True, self.halves[right][0]

    # ---- shortest path

    def shortest_path(self, text: str) -> list[int]:
        """Ids of the cheapest path through the composed machines for normalised text."""
        n = len(text)
        cost: list[float | None] = [None] * (n + 1)
        back, last = [0] * (n + 1), [""] * (n + 1)
        cost[0] = 0.0
        arc, follows, merges, most = self.arcs.get, self.pairs, self.merges, self.longest
        for j in range(1, n + 1):
            least = None
            for i in range(j - 1, max(0, j - most) - 1, -1):
                piece = text[i:j]
                weight = found = arc(piece, STOP)
                if found is STOP or found is None:
                    if i < j - 1:
                        if found is STOP:
                            break
                        continue
                    weight = -self.beyond  # byte fallback, or the unknown id, for one character
                here = cost[i]
                if here is not None and (not merges or (follows[last[i]][piece] if i else self.stable[piece])):
                    total = here + weight
                    if least is None or total <= least:
                        least, back[j], last[j] = total, i, piece
                    if merges:  # no other piece may end here
                        break
                if found is STOP:
                    break
            cost[j] = least
        spelled, ids, at = self.spelled.get, [], n
        while at > 0:
            found = spelled(last[at])
            if found is not None:
                ids.append(found)
            else:
                ids += reversed(self._ids(last[at]))
            at = back[at]
        return ids[::-1]

    def _solve(self, part: str) -> bytes:
        """Ids of a stretch, put together from its stretches between cuts."""
        if self.joined.issuperset(map(add, part, part[1:])):
            return pack(f"<{len(ids := self.shortest_path(part))}i", *ids)
        cuts = [i for i in range(1, len(part)) if part[i - 1:i + 1] not in self.joined]
        return b"".join([self.solved[part[a:b]] for a, b in zip([0, *cuts], [*cuts, len(part)])])

    def _ids(self, piece: str) -> list[int]:
        found = self.spelled.get(piece)
        if found is not None:
            return [found]
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]

    # ---- whole texts

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if not self.cuts_at_space:
            return self._solve(self.normalise(text))
        if self.shrink or "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return b"".join(map(self.solved.__getitem__, self.stretch.findall(self.normalise(text))))
        return b"".join(map(self.solved.__getitem__, ((SPACE if self.prefix else "") + text.replace(" ", " " + SPACE)).split(" ")))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        text = b"".join(map(self.out.__getitem__, ids))
        return text[1:] if self.prefix and text[:1] == b" " else text

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def transducer(path: str, stretches: int | None = None) -> PieceTransducer:
    """One machine per Python worker, so later tasks find its solved stretches."""
    return kept_alone(PieceTransducer, path, 500_000, stretches)


def encode_pieces(docs: DataFrame, model: str, columns: tuple[str, str] = ("doc_id", "text"),
                  stretches: int | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256, round_trip): the ids of every text, and what decoding them gives.

    Runs where the rows are: no shuffle, memory of one slice of a batch and the bounded memory of solved stretches
    (``stretches`` of them at most, if given).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model, stretches)
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                ids, shas, same, valid = [], [], [], []
                for text in part.column(1):
                    text = text.as_py()
                    found = np.frombuffer(machine.encode_bytes(text or ""), "<i4")
                    back = machine.decode_bytes(found.tolist())
                    ids.append(found)
                    valid.append(text is not None)
                    shas.append(hashlib.sha256(back).hexdigest() if text is not None else None)
                    same.append(back == text.encode("utf-8", "surrogatepass") if text is not None else None)
                lists = list_array(ids, pa.int32())
                off = np.array(valid, bool)
                lists = lists if off.all() else pa.ListArray.from_arrays(lists.offsets, lists.values, mask=pa.array(~off))
                counts = np.array([len(i) for i in ids], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(counts), pa.array(shas, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "ids", "n_tokens", "decoded_sha256", "round_trip"])

    return docs.select(*columns).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)[columns[0]]}, ids array<int>, n_tokens int, decoded_sha256 string, round_trip boolean")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            texts = [None if ids is None else machine.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the digest of the text they decode to."""
    return encode_pieces(documents(spark, sf_dir), vocabulary_path("piece_bpe_32k.model"))
