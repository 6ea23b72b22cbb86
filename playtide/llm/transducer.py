"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

The model file is compiled once per worker. The normaliser maps blanks to the word mark and puts one mark in front. The pieces are
arcs over the normalised characters; a character without a piece has a path of byte arcs. In a byte-pair model a boundary between
two pieces weighs nothing if merging their joined characters, best piece first, ends in just these two, and infinity if not: a
merge never depends on more than the pieces at both sides of a boundary. So exactly one path has a finite weight, and it is the
model's encoding. A depth-first search over the composed lattice, longest arcs first, finds it; a position from which no finite path
leads on is never entered again, since every prefix has only one finite path too.

No piece holds a mark behind another character, so texts are composed unit by unit (a run of marks and what follows).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import sliced, table, texts
from playtide.llm.units import UnitTable, in_a_row

MARK = "\u2581"
#: Pairs of pieces whose boundary weight a worker remembers.
MOST_PAIRS = 1_000_000
STEP_BYTES = 2 << 20


class Transducer:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self._check_normaliser(model, path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(self.pieces)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.arcs = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: model.get_score(i) for i in plain}
        self.starts = {p[:k] for p in self.arcs for k in range(1, len(p) + 1)}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(MARK in p.lstrip(MARK) for p in self.arcs) or any(c not in self.arcs for p in self.arcs for c in p):
            raise ValueError("pieces must keep marks in front and be made of characters that are pieces")
        byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.spelled = [
            bytes([byte_of[i]]) if i in byte_of else b"" if model.is_control(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.table = UnitTable(self.units, lambda units: in_a_row(map(self.path, units)))

    @staticmethod
    def _check_normaliser(model, path: str) -> None:
        probe = "A\u00e9\ufb01 \t x "
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError(f"{path}: only models that leave characters as they are and put a mark in front are compiled")

    def units(self, text: str) -> list[str]:
        """The normalised text, cut before each run of marks."""
        if not text:
            return []
        words = text.replace(MARK, " ").split(" ")
        if "" not in words:
            return [MARK + w for w in words]
        out, marks = [], ""
        for word in words:
            marks += MARK
            if word:
                out.append(marks + word)
                marks = ""
        return [*out, marks] if marks else out

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, the leftmost of equals, until none makes a piece."""
        parts, worst = list(text), float("-inf")
        score = lambda i: self.score.get(parts[i] + parts[i + 1], worst)
        scores = [score(i) for i in range(len(parts) - 1)]
        while scores and (best := max(scores)) > worst:
            at = scores.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = score(at)
            if at:
                scores[at - 1] = score(at - 1)
        return parts

    def finite(self, left: str, right: str) -> bool:
        """Whether the boundary between two pieces has a finite weight."""
        if left + right in self.arcs:
            return False
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return found

    def arcs_from(self, unit: str, at: int) -> list[str]:
        """Pieces that begin here, shortest first; an empty one stands for the byte arcs of a character without a piece."""
        arcs, starts, out = self.arcs, self.starts, []
        for end in range(at + 1, len(unit) + 1):
            text = unit[at:end]
            if text not in starts:
                break
            if text in arcs:
                out.append(text)
        return out or [""]

    def path(self, unit: str) -> list[int]:
        """Ids along the finite path through one unit."""
        n, at, last = len(unit), 0, ""
        dead: set[int] = set()
        trail: list[tuple[int, str, list[str]]] = []  # where an arc starts, its piece, the arcs still to try there
        options = self.arcs_from(unit, 0)
        while at < n:
            while options:
                piece = options.pop()
                # No merge crosses a character without a piece: its boundaries weigh nothing.
                if at + (len(piece) or 1) not in dead and (
                        not piece or (self.finite(last, piece) if last else self.single(piece))):
                    trail.append((at, piece, options))
                    at, last = at + (len(piece) or 1), piece
                    options = self.arcs_from(unit, at) if at < n else []
                    break
            else:
                dead.add(at)
                at, _, options = trail.pop()
                last = trail[-1][1] if trail else ""
        out: list[int] = []
        for start, piece, _ in trail:
            if piece:
                out.append(self.arcs[piece])
            else:
                out.extend(self.byte_ids[b] for b in unit[start].encode())
        return out

    def single(self, piece: str) -> bool:
        """Whether a piece may come first: merging its own characters gives the piece."""
        found = self.pairs.get((piece, ""))
        if found is None:
            found = self.pairs[piece, ""] = self.merged(piece) == [piece]
        return found

    def decode(self, ids: np.ndarray) -> str:
        """Pieces and bytes back to text, without the mark in front."""
        spelled = self.spelled
        # A mark may also come as its bytes.
        text = b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=4)
def compiled(path: str) -> Transducer:
    return Transducer(path)


def _encoded(path: str, back: bool):
    def run(batches):
        model = compiled(path)
        for batch in batches:
            docs = texts(batch["text"])
            for part in sliced(docs, STEP_BYTES):
                plain = [x.decode() for x in docs[part]]
                ids, lengths = model.table.encode(plain)
                borders = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                columns = {
                    "doc_id": batch["doc_id"].slice(part.start, part.stop - part.start), "n_tokens": pa.array(lengths, pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(borders), pa.array(ids, pa.int32()))}
                if back:
                    decoded = [model.decode(ids[a:b]) for a, b in zip(borders[:-1], borders[1:])]
                    columns["decoded"] = pa.array(decoded, pa.string())
                    columns["same"] = pa.array([x == y.replace(MARK, " ") for x, y in zip(decoded, plain)], pa.bool_())
                yield pa.record_batch(columns)

    return run


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids of every row, by the model file ``model`` (a path every node has).

    Null texts count as empty and have no ids. Nothing is dropped, repeated rows and null ids included; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_encoded(model, False), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids array<int>")


def encode_and_decode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``encode``, decoded (the text that the ids stand for) and same (whether that is the normalised input)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encoded(model, True), f"doc_id {kind}, n_tokens long, ids array<int>, decoded string, same boolean")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column decoded: the text the ids stand for (null ids: null)."""
    @F.pandas_udf("string")
    def back(column):
        known = compiled(model)
        return column.map(lambda x: None if x is None else known.decode(np.asarray(x)))

    return encoded.withColumn("decoded", back(F.col(ids)))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark, folder: str) -> DataFrame:
    return encode_and_decode(table(spark, folder, "documents"), model_path())
