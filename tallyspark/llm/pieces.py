"""SentencePiece encoding and decoding by a batched numpy Viterbi.

Words of equal length form a matrix of characters, of a bounded number of
cells, and advance together, one end place at a time.  The hash of every
substring that ends there is looked up among the sorted hashes of the pieces,
and a maximum over the start places gives each word its backpointer.

* In a unigram model the value of a path is the sum of its scores.
* In a byte-pair model the library applies merges in the order of their ranks,
  which no sum of scores reproduces.  But a path is the one that merging gives
  exactly if each two neighbours on it are: ``Model.compatible`` undoes the
  merges of both sides, latest first, and asks whether a merge across would
  have come earlier.  The value of a step is then 1 or nothing, so the maximum
  is the first compatible start.

Both give the ids of the sentencepiece library, which is only used to read the
model file.  Characters without a piece become the pieces of their UTF-8 bytes,
or the unknown id in a model without those.

Null and empty texts have no ids.  Repeated rows are encoded each.  The time of
a word grows with its length and nothing is cut.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, slices
from .words import P, P_INVERSE, mix

SPACE = "▁"
#: Words of a worker's memory in each of two generations.
REMEMBERED = 400_000
#: Characters of the words that advance together; each takes some hundred bytes.
CELLS = 1 << 17
#: Bits of a hash by which most substrings that are no piece are told at once.
PROBE = 20
SLICE = 8 << 20
NEVER = np.int64(1) << 40

SCHEMA = "doc_id long, n_pieces long, ids array<int>, round_trip boolean"


def up(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.r_[np.uint64(1), np.full(n, P)], dtype=np.uint64)


def down(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.r_[np.uint64(1), np.full(n, P_INVERSE)], dtype=np.uint64)


def codes(words: list[str], width: int) -> np.ndarray:
    """Code points, one word a row, filled up with zeros."""
    raw = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
    return raw.reshape(len(words), width).astype(np.uint64)


def raw_hashes(rows: np.ndarray) -> np.ndarray:
    """Prefix sums of (code + 1) * P**place, with a first column of zeros."""
    sums = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
    np.cumsum((rows + np.uint64(1)) * up(rows.shape[1])[: rows.shape[1]], axis=1, out=sums[:, 1:])
    return sums


class Model:
    """The pieces of a model as arrays; small enough to send to every task."""

    def __init__(self, path: str, merges: bool | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        byte = [i for i in range(n) if sp.is_byte(i)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in byte}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)} | set(byte)
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.prefix = sp.encode_as_pieces("a")[0].startswith(SPACE)
        usable = np.array([i not in special for i in range(n)])
        whole = self.score[usable]
        # Scores of a byte-pair model are the numbers of its merges.
        self.merges = bool((whole == np.round(whole)).all()) if merges is None else merges
        self.rank = np.where(usable, -self.score, NEVER).astype(np.int64)
        self.length = np.array([len(p) for p in self.pieces])
        self.left = np.arange(n)
        self.right = np.arange(n)
        if self.merges:
            usable &= self.derive(usable)
        self.rank[self.length == 1] = -1
        self.widest = int(self.length[usable].max())
        table = codes(self.pieces, int(self.length.max()))
        self.raw = raw_hashes(table)[np.arange(n), self.length]
        key = mix(self.raw + self.length.astype(np.uint64))
        # Of pieces that merging never makes, only the lookup of pairs knows.
        self.all_ids = np.flatnonzero(~np.isin(np.arange(n), list(special)))
        self.all_ids = self.all_ids[np.argsort(key[self.all_ids])]
        self.all_keys = key[self.all_ids]
        self.probe = np.zeros(1 << PROBE, bool)
        self.probe[self.all_keys >> np.uint64(64 - PROBE)] = True
        self.usable = usable
        text = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for value, i in self.byte_ids.items():
            text[i] = bytes([value])
        for i in special - set(byte):
            text[i] = b"" if i != self.unknown else " ⁇ ".encode()
        self.bytes_at = np.cumsum([0, *map(len, text)])
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        inner = any(SPACE in p.lstrip(SPACE) for i, p in enumerate(self.pieces) if i not in special)
        line = any("\n" in p for i, p in enumerate(self.pieces) if i not in special)
        # No piece spans these cuts, so no path does.
        self.cut = None if inner or line else re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def derive(self, usable: np.ndarray) -> np.ndarray:
        """The last merge of each piece; false for a piece that merging never makes."""
        of = {self.pieces[i]: i for i in np.flatnonzero(usable)}
        made = np.ones(len(usable), bool)
        for piece, i in of.items():
            parts, pair = list(piece), None
            while len(parts) > 1:
                found = [(self.rank[of[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in of]
                if not found:
                    break
                k = min(found)[1]
                pair = parts[k : k + 2]
                parts[k : k + 2] = ["".join(pair)]
            made[i] = len(parts) == 1 and (pair is None or all(p in of for p in pair))
            if made[i] and pair:
                self.left[i], self.right[i] = of[pair[0]], of[pair[1]]
        return made

    def look_up(self, raw: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        key = mix(raw + np.asarray(length).astype(np.uint64))
        ids = np.full(key.shape, -1, np.int64)
        maybe = np.nonzero(self.probe[key >> np.uint64(64 - PROBE)])
        some = key[maybe]
        at = np.minimum(np.searchsorted(self.all_keys, some), len(self.all_keys) - 1)
        ids[maybe] = np.where(self.all_keys[at] == some, self.all_ids[at], -1)
        return ids

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces ``a`` and ``b`` side by side; -1: no piece."""
        fine = np.ones(len(a), bool)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        x, y = a[open_], b[open_]
        before = np.full(len(open_), NEVER)
        powers = up(self.widest)
        while len(open_):
            both = self.look_up(self.raw[x] + powers[self.length[x]] * self.raw[y], self.length[x] + self.length[y])
            across = np.where(both >= 0, self.rank[both], NEVER) < before
            fine[open_[across]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~across & ((rx >= 0) | (ry >= 0))
            open_, x, y, rx, ry = open_[go], x[go], y[go], rx[go], ry[go]
            # The later merge is undone; of equal ones the right one is later,
            # and a merge across of the same rank comes before it.
            undo_x = rx > ry
            before = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return fine

    def viterbi(self, words: list[str]) -> list[list[int]]:
        """The ids of words of equal length."""
        n, width = len(words), len(words[0])
        sums = raw_hashes(codes(words, width))
        falls = down(width)
        back = np.zeros((n, width + 1), np.int32)
        piece = np.full((n, width + 1), -1, np.int32)
        value = np.zeros((n, width + 1))
        lost = float(self.score.min()) - 10
        row = np.arange(n)
        for e in range(1, width + 1):
            starts = np.arange(max(0, e - self.widest), e)
            ids = self.look_up((sums[:, e][:, None] - sums[:, starts]) * falls[starts], e - starts)
            if self.merges:
                # A single character is always a step, with or without a piece.
                r, c = np.nonzero((ids >= 0) & self.usable[ids])
                s, found = starts[c], ids[r, c]
                # A start place that merging cannot end a piece at has no value.
                ok = (s == 0) | self.compatible(np.where(s > 0, piece[r, s], -1).astype(np.int64), found)
                r, s, found = r[ok], s[ok], found[ok]
                first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else r
                back[:, e] = e - 1
                last = ids[:, -1]
                piece[:, e] = np.where((last >= 0) & self.usable[last], last, -1)
                back[r[first], e], piece[r[first], e] = s[first], found[first]
                continue
            ids = np.where((ids >= 0) & self.usable[ids], ids, -1)
            step = value[:, starts] + np.where(ids >= 0, self.score[ids], -np.inf)
            bare = ids[:, -1] < 0
            step[bare, -1] = value[:, starts[-1]][bare] + lost
            best = np.argmax(step, axis=1)
            back[:, e], piece[:, e], value[:, e] = starts[best], ids[row, best], step[row, best]
        out = []
        for i, word in enumerate(words):
            path, e = [], width
            while e:
                s = int(back[i, e])
                if piece[i, e] >= 0:
                    path.append(int(piece[i, e]))
                elif self.byte_ids:
                    path += [self.byte_ids[b] for b in reversed(word[s:e].encode())]
                elif not path or path[-1] != self.unknown:
                    path.append(self.unknown)
                e = s
            out.append(path[::-1])
        return out

    def words_of(self, text: str) -> list[str]:
        if not text:
            return []
        whole = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        return self.cut.findall(whole) if self.cut else [whole]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes that runs of ids stand for, without the added space."""
        size = np.diff(self.bytes_at)[ids]
        ends = np.cumsum(size)
        index = np.arange(int(size.sum())) + np.repeat(self.bytes_at[ids] - (ends - size), size)
        data = self.bytes[index].tobytes()
        at = np.r_[0, ends][bounds]
        skip = 1 if self.prefix else 0
        return [data[a + min(skip, b - a) : b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


class Encoder:
    """A model with a worker's memory of words."""

    def __init__(self, model: Model):
        self.model, self.words, self.older = model, {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as 32-bit numbers."""
        if len(self.words) > REMEMBERED:
            self.words, self.older = {}, self.words
        split = [self.model.words_of(t or "") for t in texts]
        new = []
        for w in set().union(*split) - self.words.keys():
            ids = self.older.get(w)
            if ids is None:
                new.append(w)
            else:
                self.words[w] = ids
        new.sort(key=len)
        a = 0
        while a < len(new):
            width = len(new[a])
            b = min(bisect_right(new, width, key=len), a + max(1, CELLS // width))
            part = new[a:b]
            for w, ids in zip(part, self.model.viterbi(part), strict=True):
                self.words[w] = array("I", ids).tobytes()
            a = b
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in split]


_encoders: dict[int, Encoder] = {}


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_pieces, ids and whether decoding gives the text again."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        enc = _encoders.setdefault(id(model), Encoder(model))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                packed = enc.encode(texts)
                bounds = np.r_[0, np.cumsum([len(x) // 4 for x in packed])]
                ids = np.frombuffer(b"".join(packed), "<i4")
                same = [b == (t or "").encode() for b, t in zip(model.decode(ids, bounds), texts, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(bounds)), lists, pa.array(same)], names=["doc_id", "n_pieces", "ids", "round_trip"])

    docs = clean_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """The rows with a column ``text`` decoded from ids; broken UTF-8 is replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(Model(model_path))
    rows = encoded.select("doc_id", F.col(f"`{ids_column}`").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            sizes = np.nan_to_num(lists.value_lengths().fill_null(0).to_numpy()).astype(np.int64)
            texts = shared.value.decode(lists.flatten().to_numpy().astype(np.int64), np.r_[0, np.cumsum(sizes)])
            yield pa.record_batch([batch.column("doc_id"), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, "doc_id long, text string")
