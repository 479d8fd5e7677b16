"""Encoding and decoding with the pieces of a SentencePiece vocabulary by batched Viterbi.

A text is a dummy blank and itself, blanks shown as U+2581. It is cut where a blank
follows another character; no piece of the vocabulary spans such a cut (checked on
loading), so words are independent. Words not met before are encoded together: words of
equal length advance together, one character a step; for every end and every piece length
the rolling hash of the substring probes the sorted hashes of the pieces of that length,
and vectorised maxima keep the best score and a back-pointer. The segmentation has the
largest sum of piece scores, the earlier start winning ties; a character without a piece
scores the least piece's score minus 10 and becomes its UTF-8 bytes' pieces.

Decoding joins the pieces, turns byte pieces back into bytes and drops the dummy blank.

Both are one pass per row without a shuffle; remembered words are bounded in number.

Defined cases: a null text has null ids and decodes to null; an empty text has no ids;
very long words are one more length class; a text that holds U+2581 itself decodes to
blanks there, as the vocabulary cannot tell them apart; repeated rows are encoded alike;
an empty table gives an empty result; carried columns that clash are dropped.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

BLANK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
# Words remembered (in each of two generations), and characters and rows handled at once.
LIMIT, BLOCK, ROWS = 400_000, 1 << 20, 512


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _horner(points: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes (rows x length + 1) of rows of code points."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for i in range(points.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + points[:, i]
    return out


def _points(words: list[str], length: int) -> np.ndarray:
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, "<u4").reshape(len(words), length).astype(np.uint64) + np.uint64(1)


class Pieces:
    """The vocabulary: pieces' sorted hashes per length, with ids and scores."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: dict[int, int]):
        """``pieces``: (piece, score) by id, an empty string for ids that no text yields;
        ``byte_ids``: the id of each byte."""
        self.byte_ids = byte_ids
        usable = [(p, i, s) for i, (p, s) in enumerate(pieces) if p]
        self.longest = max(len(p) for p, _, _ in usable)
        self.unknown = min(s for _, _, s in usable) - 10.0
        for p, _, _ in usable:
            if re.search(f"[^{BLANK}]{BLANK}", p):
                raise ValueError(f"piece {p!r} spans a word's end")
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in range(1, self.longest + 1):
            own = [(p, i, s) for p, i, s in usable if len(p) == n]
            if own:
                keys = _horner(_points([p for p, _, _ in own], n))[:, -1]
                order = np.argsort(keys, kind="stable")
                if len(np.unique(keys)) != len(keys):
                    raise ValueError("two pieces share a hash")
                self.by_length[n] = (keys[order], np.array([i for _, i, _ in own])[order],
                                     np.array([s for _, _, s in own], np.float64)[order])
        self.text = [p.replace(BLANK, " ").encode("utf-8", "surrogatepass") for p, _ in pieces]
        for b, i in byte_ids.items():
            self.text[i] = bytes([b])
        self.bytes = frozenset(byte_ids.values())
        self.met: dict[str, bytes] = {}  # ids of words met lately
        self.old: dict[str, bytes] = {}  # and of those met before

    @classmethod
    def load(cls, path: str) -> "Pieces":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = [], {}
        for i in range(sp.vocab_size()):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            plain = not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
            pieces.append((sp.id_to_piece(i) if plain else "", sp.get_score(i)))
        return cls(pieces, byte_ids)

    def viterbi(self, words: list[str], length: int) -> list[bytes]:
        """Ids, as little-endian 32-bit numbers, of words that are all ``length`` long."""
        n = len(words)
        prefix = _horner(_points(words, length))
        sizes = [k for k in range(min(length, self.longest), 0, -1) if k in self.by_length]
        # Score and id of the piece of each size that ends at each place, longest first.
        score = np.full((length + 1, n, len(sizes) + 1), -np.inf)
        found = np.full((length + 1, n, len(sizes) + 1), -1, np.int32)
        for j, size in enumerate(sizes):
            keys, ids, scores = self.by_length[size]
            h = (prefix[:, size:] - prefix[:, :-size] * _power(size)).T
            at = np.searchsorted(keys, h)
            at[at == len(keys)] = 0
            end, row = np.nonzero(keys[at] == h)
            hit = at[end, row]
            score[end + size, row, j] = scores[hit]
            found[end + size, row, j] = ids[hit]
        # A character without a piece of its own, last of all.
        lone = found[:, :, sizes.index(1)] < 0 if 1 in sizes else np.ones((length + 1, n), bool)
        score[:, :, -1][lone] = self.unknown
        steps = np.array([*sizes, 1])
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0.0
        back = np.zeros((length + 1, n), np.int32)
        row = np.arange(n)
        for end in range(1, length + 1):
            usable = np.flatnonzero(steps <= end)
            total = best[end - steps[usable]].T + score[end][:, usable]
            top = total.argmax(axis=1)
            best[end] = total[row, top]
            back[end] = usable[top]
        # All words walk back together; ids are filled in from the right.
        place, out = np.full(n, length), np.full((n, length), -2, np.int32)
        while (going := place > 0).any():
            rows = row[going]
            ends = place[rows]
            out[rows, ends - 1] = found[ends, rows, back[ends, rows]]
            place[rows] = ends - steps[back[ends, rows]]
        used = out > -2
        stops = np.cumsum(used.sum(axis=1)).tolist()
        flat = out[used].astype("<i4").tobytes()
        result = [flat[4 * a:4 * b] for a, b in zip([0, *stops], stops)]
        for i in np.flatnonzero((out == -1).any(axis=1)).tolist():
            ids: list[int] = []
            for e, v in enumerate(out[i].tolist()):
                if v >= 0:
                    ids.append(v)
                elif v == -1:
                    ids += [self.byte_ids[b] for b in words[i][e].encode("utf-8", "replace")]
            result[i] = np.array(ids, "<i4").tobytes()
        return result

    def learn(self, words: set[str]) -> None:
        """Encode words not met before, by length; in blocks of bounded size."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w) + 1, []).append(w)
        for length, group in by_length.items():
            block = max(1, 50_000 // (length + 1))
            for i in range(0, len(group), block):
                part = group[i:i + block]
                self.met.update(zip(part, self.viterbi([BLANK + w for w in part], length)))

    @staticmethod
    def words(text: str) -> list[str]:
        """The words of a text; a blank before each is understood."""
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " " or BLANK in text:
            return [w[1:] for w in _WORD.findall(BLANK + text.replace(" ", BLANK))]
        return text.split(" ")

    def encode(self, batch: list[str | None]) -> list[bytes | None]:
        """Little-endian 32-bit ids of each text."""
        out: list[bytes | None] = []
        for block in blocks(batch, BLOCK):
            cut = [None if t is None else self.words(t) for t in block]
            if len(self.met) > LIMIT:
                self.old, self.met = self.met, {}
            new = set(itertools.chain.from_iterable(w for w in cut if w)).difference(self.met)
            self.met.update((w, self.old[w]) for w in new if w in self.old)
            self.learn(new.difference(self.met))
            get = self.met.__getitem__
            out += [None if words is None else b"".join(map(get, words)) for words in cut]
        return out

    def decode(self, ids: list[int]) -> str:
        text = self.text
        return b"".join([text[i] for i in ids]).decode("utf-8", "replace")[1:]


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces.load(path)
    return _LOADED[path]


def _mapped(df: DataFrame, source: str, results: dict[str, str], carry: list[str], fn) -> DataFrame:
    """``carry`` columns and what ``fn`` makes of the ``source`` column, a block at a time so
    that a task holds the words of one block and not of a whole batch."""
    carry = [c for c in carry if c not in results and c != "_in"]
    kept = df.select(*[F.col(f"`{c}`") for c in carry], F.col(source).alias("_in"))
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]),
                     *(f"`{n}` {t}" for n, t in results.items())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), *fn(part.column("_in"))],
                                                 names=[*carry, *results])

    return kept.mapInArrow(run, ddl)


def _lists(found: list[bytes | None]) -> pa.Array:
    """Ids as an Arrow column of lists."""
    sizes = np.array([len(x) // 4 if x is not None else 0 for x in found], np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join([x for x in found if x]), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([x is None for x in found], pa.bool_()))


def encode(df: DataFrame, carry: list[str], *, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``carry`` columns of each row and the ids (array<int>) of its text."""
    model = path or model_path()
    return _mapped(df, text, {ids: "array<int>"}, carry, lambda c: [_lists(loaded(model).encode(c.to_pylist()))])


def decode(df: DataFrame, carry: list[str], *, ids: str = "ids", text: str = "text", path: str | None = None) -> DataFrame:
    """``carry`` columns of each row and the text of its ids."""
    model = path or model_path()

    def fn(column: pa.Array) -> list[pa.Array]:
        return [pa.array([None if i is None else loaded(model).decode(i) for i in column.to_pylist()], pa.string())]

    return _mapped(df, ids, {text: "string"}, carry, fn)


def encode_and_decode(df: DataFrame, carry: list[str], *, text: str = "text", ids: str = "ids",
                      decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``carry`` columns of each row, the ids of its text, and the text those ids decode to:
    ``encode`` and ``decode`` in one pass."""
    model = path or model_path()

    def fn(column: pa.Array) -> list[pa.Array]:
        found = loaded(model).encode(column.to_pylist())
        back = [None if x is None else loaded(model).decode(np.frombuffer(x, "<i4").tolist()) for x in found]
        return [_lists(found), pa.array(back, pa.string())]

    return _mapped(df, text, {ids: "array<int>", decoded: "string"}, carry, fn)
