"""SentencePiece encoding (unigram Viterbi) and decoding.

The pieces of a model file and their log scores go into a double-array trie over UTF-8 bytes. The
best segmentation of a unit of text is the Viterbi path over all pieces the trie finds in it; a
character that no piece covers costs an unknown penalty and is written as byte pieces. White space
becomes the marker U+2581 and a marker goes before the text; decoding reverses both.

No piece holds a marker behind another character (this is checked when the model is loaded), so a
path over the whole text is the concatenation of the paths of its units (markers and the characters
up to the next marker). Units repeat, so their paths are remembered in a bounded table; the new units
of a batch of texts walk the trie together, one byte a step.

Defined cases: null and empty texts have no ids and decode to the empty text; texts are encoded
whole; U+2581 in a text is a space afterwards, as the marker is the space (``round_trip`` is false
there); repeated rows give repeated results; an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

import re
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfrank.llm.common import table, text_slices
from shelfrank.llm.registry import query

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"   # default of the parameter ``model_file``
MARKER = "▁"
# fixed values: piece types of the model format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0                               # below the lowest piece score
SHORT, TOGETHER = 64, 4096                           # characters of a remembered unit; units that step together


def _fields(raw: bytes):
    """(field number, value) of a protocol-buffer message."""
    i, n = 0, len(raw)

    def varint(i):
        x = shift = 0
        while True:
            b = raw[i]
            x |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return x, i

    while i < n:
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            size, i = varint(i)
            value, i = raw[i:i + size], i + size
        elif kind == 5:
            value, i = struct.unpack("<f", raw[i:i + 4])[0], i + 4
        else:
            value, i = raw[i:i + 8], i + 8
        yield tag >> 3, value


def read_model(raw: bytes):
    """(list of (piece, score, type), normaliser settings) of a model file."""
    pieces, norm = [], {3: 1, 4: 1, 5: 1}
    for number, value in _fields(raw):
        if number == 1:
            p = {1: b"", 2: 0.0, 3: NORMAL} | dict(_fields(value))
            pieces.append((p[1].decode("utf-8"), p[2], p[3]))
        elif number == 3:
            norm |= dict(_fields(value))
    return pieces, norm


class DoubleArray:
    """Trie over bytes in two arrays: node s has the child base[s] + byte + 1 if check there is s."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in keys:
            node = 0
            for b in key:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = nxt
            ends[node] = value
        size = 4 * len(children) + 1024
        base, check, value = array("i", [0]) * size, array("i", [-1]) * size, array("i", [-1]) * size
        place = {0: 0}
        check[0] = 0
        free = 1
        queue = [0]
        for node in queue:
            kids = sorted(children[node])
            if not kids:
                continue
            s = place[node]
            while check[free] != -1:
                free += 1
            start, tried = free - kids[0] - 1, 0
            while start < 0 or any(check[start + b + 1] != -1 for b in kids):
                start, tried = start + 1, tried + 1
                if start + 258 >= size:
                    more = size
                    base.extend([0] * more), check.extend([-1] * more), value.extend([-1] * more)
                    size += more
            if tried > 64:            # the cells up to here are nearly all taken: look behind them from now on
                free = start + kids[0] + 1
            base[s] = start
            for b in kids:
                t = start + b + 1
                check[t] = s
                child = children[node][b]
                value[t] = ends[child]
                place[child] = t
                queue.append(child)
        # 257 further cells, so that a look-up never leaves the arrays
        self.base, self.check, self.value = (np.array(a, np.int32) for a in (base, check, value))

    def lists(self):
        return self.base.tolist(), self.check.tolist(), self.value.tolist()


def file_bytes(spark, path: str) -> bytes:
    """A vocabulary file: a path of the driver's machine, or a URL of any store that Spark reaches."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


class UnigramModel:
    """Pieces, scores and trie of a model file; plain data that is shipped to the tasks once."""

    def __init__(self, raw: bytes):
        pieces, norm = read_model(raw)
        if norm.get(2):
            raise ValueError("models with a character-normalisation table are not supported")
        self.dummy_prefix, self.squeeze = bool(norm[3]), bool(norm[4])
        self.pieces = [p for p, _, _ in pieces]
        self.types = [t for _, _, t in pieces]
        self.scores = [s for _, s, _ in pieces]
        normal = [i for i, t in enumerate(self.types) if t in (NORMAL, USER_DEFINED)]
        if any(MARKER in self.pieces[i].lstrip(MARKER) for i in normal):
            raise ValueError("a piece holds the marker behind another character")
        self.unknown_score = min(self.scores[i] for i in normal) - UNKNOWN_PENALTY
        self.byte_ids = [-1] * 256
        for i, t in enumerate(self.types):
            if t == BYTE:
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.unknown_id = self.types.index(UNKNOWN) if UNKNOWN in self.types else 0
        self.trie = DoubleArray([(self.pieces[i].encode(), i) for i in normal])
        # a line feed that no piece holds separates units as well
        alone = "\n" if not any("\n" in self.pieces[i] for i in normal) else ""
        self.unit_pattern = f"{MARKER}*[^{MARKER}{alone}]+|{MARKER}+" + (f"|{alone}+" if alone else "")
        self.width = "<u2" if len(pieces) <= 65536 else "<i4"

    @classmethod
    def load(cls, spark, model_file: str = MODEL_FILE) -> UnigramModel:
        return cls(file_bytes(spark, model_file))

    def open(self) -> Encoder:
        """Encoder of one task."""
        return Encoder(self)


class Encoder:
    """Encoder and decoder of one task."""

    def __init__(self, model: UnigramModel, remembered: int = 150_000):
        self.m, self.width = model, model.width
        self.base, self.check, self.value = model.trie.lists()
        self.trie, self.scores = model.trie, np.array(model.scores, float)
        lead = np.arange(256)
        self.char_bytes = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        self.units = re.compile(model.unit_pattern).findall
        # ids of units, with the marker before the key in ``marked``, as they stand in ``cache``
        self.limit, self.cache, self.marked = remembered, {}, {}
        self.by_line = "\n" in model.unit_pattern and model.dummy_prefix and not model.squeeze
        self.surface = [(MARKER if t != NORMAL and t != USER_DEFINED and t != BYTE else p).replace(MARKER, " ").encode()
                        for p, t in zip(model.pieces, model.types, strict=True)]
        for i, t in enumerate(model.types):
            if t == CONTROL:
                self.surface[i] = b""
        for b, i in enumerate(model.byte_ids):
            if i >= 0:
                self.surface[i] = bytes([b])

    def viterbi(self, unit: str) -> list[int]:
        """Ids of the best path over ``unit``; of equal scores the path through the longest, then
        earliest piece found first stays."""
        raw = unit.encode("utf-8")
        n = len(raw)
        base, check, value, scores = self.base, self.check, self.value, self.m.scores
        best, start, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        i = 0
        while i < n:
            lead = raw[i]
            char = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, node, j, single = best[i], 0, i, False
            while j < n:
                t = base[node] + raw[j] + 1
                if check[t] != node:
                    break
                node, j = t, j + 1
                v = value[t]
                if v >= 0:
                    s = here + scores[v]
                    if best[j] is None or s > best[j]:
                        best[j], start[j], piece[j] = s, i, v
                    if j == i + char:
                        single = True
            if not single:
                s, j = here + self.m.unknown_score, i + char
                if best[j] is None or s > best[j]:
                    best[j], start[j], piece[j] = s, i, -1
            i += char
        out, j = [], n
        while j > 0:
            i = start[j]
            if piece[j] >= 0:
                out.append(piece[j])
            else:
                ids = [self.m.byte_ids[b] for b in raw[i:j]]
                out.extend(reversed(ids if min(ids) >= 0 else [self.m.unknown_id]))
            j = i
        return out[::-1]

    def viterbi_all(self, units: list[str]) -> list[bytes]:
        """``viterbi`` of many short units at once: from every position all units that reach it step
        through the trie side by side."""
        raws = [u.encode("utf-8") for u in units]
        order = sorted(range(len(units)), key=lambda u: len(raws[u]))
        out: list = [None] * len(units)
        for s in range(0, len(order), TOGETHER):
            chosen = order[s:s + TOGETHER]
            longest = len(raws[chosen[-1]])
            data = np.frombuffer(b"".join(raws[u].ljust(longest, b"\0") for u in chosen), np.uint8).reshape(len(chosen), longest)
            ends = np.array([len(raws[u]) for u in chosen])
            best = np.full((len(chosen), longest + 1), -np.inf)
            best[:, 0] = 0.0
            start, piece = np.zeros(best.shape, np.int32), np.full(best.shape, -1, np.int32)

            def reach(rows, to, score, i, v, best=best, start=start, piece=piece):
                better = score > best[rows, to]
                rows, to = rows[better], to[better] if hasattr(to, "shape") else to
                best[rows, to], start[rows, to], piece[rows, to] = score[better], i, v[better] if hasattr(v, "shape") else v

            for i in range(longest):
                rows = np.flatnonzero((i < ends) & (data[:, i] & 0xC0 != 0x80))
                if not len(rows):
                    continue
                here, after = best[rows, i], i + self.char_bytes[data[rows, i]]
                single = np.zeros(len(rows), bool)
                live, node = np.arange(len(rows)), np.zeros(len(rows), np.int32)
                for j in range(i, longest):
                    r = rows[live]
                    to = self.trie.base[node] + data[r, j] + 1
                    on = (self.trie.check[to] == node) & (j < ends[r])
                    live, node = live[on], to[on]
                    if not len(live):
                        break
                    v = self.trie.value[node]
                    hit = np.flatnonzero(v >= 0)
                    if len(hit):
                        at, v = live[hit], v[hit]
                        reach(rows[at], j + 1, here[at] + self.scores[v], i, v)
                        single[at[after[at] == j + 1]] = True
                lack = np.flatnonzero(~single)
                if len(lack):
                    reach(rows[lack], after[lack], here[lack] + self.m.unknown_score, i, -1)
            # back from the ends: every piece's id at its last byte, byte pieces at their own bytes
            ids = np.full(best.shape, -1, np.int32)
            rows, j = np.flatnonzero(ends > 0), ends[ends > 0]
            while len(rows):
                i, v = start[rows, j], piece[rows, j]
                ids[rows, j] = v
                for r, x, y in zip(rows[v < 0], i[v < 0], j[v < 0], strict=True):
                    own = [self.m.byte_ids[b] for b in data[r, x:y]]
                    if min(own) >= 0:
                        ids[r, x + 1:y + 1] = own
                    else:
                        ids[r, y] = self.m.unknown_id
                rows, j = rows[i > 0], i[i > 0]
            flat = ids[ids >= 0].astype(self.m.width).tobytes()
            size = np.dtype(self.m.width).itemsize
            last = (np.cumsum((ids >= 0).sum(1)) * size).tolist()
            for u, x, y in zip(chosen, [0, *last[:-1]], last, strict=True):
                out[u] = flat[x:y]
        return out

    def prepare(self, texts: list[str | None]):
        """Remember the paths of all units of ``texts`` that are at most ``SHORT`` characters long."""
        plain, marked = set(), set()
        for text in texts:
            if not text:
                continue
            if not self._simple(text):
                plain.update(self.units(self.normalized(text)))
                continue
            lines = text.split("\n")
            marked.update(lines[0].split(" "))
            for line in lines[1:]:
                words = line.split(" ")
                plain.add(words[0])
                marked.update(words[1:])
        plain.add("\n")
        plain.discard("")
        for cache, keys, mark in ((self.cache, plain, ""), (self.marked, marked, MARKER)):
            keys = [k for k in keys if len(k) <= SHORT]
            new = [k for k in keys if k not in cache]
            if len(cache) + len(new) > self.limit:
                cache.clear()
                new = keys
            for k, ids in zip(new, self.viterbi_all([mark + k for k in new]), strict=True):
                cache[k] = ids

    def _simple(self, text: str) -> bool:
        """Single blanks only: a word is a unit with its marker, a line's first word one without."""
        return self.by_line and text[0] != " " and "  " not in text and MARKER not in text

    def _remember(self, unit: str) -> bytes:
        return self._learn(self.cache, unit, unit)

    def _remember_marked(self, word: str) -> bytes:
        return self._learn(self.marked, word, MARKER + word)

    def _learn(self, cache: dict, key: str, unit: str) -> bytes:
        ids = np.array(self.viterbi(unit), self.m.width).tobytes()
        if len(key) <= SHORT:
            if len(cache) >= self.limit:
                cache.clear()
            cache[key] = ids
        return ids

    def normalized(self, text: str) -> str:
        if self.m.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        text = text.replace(" ", MARKER)
        return MARKER + text if self.m.dummy_prefix and text else text

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, self.m.width)
        get, make = self.cache.get, self._remember
        if self._simple(text):
            marked, learn, parts = self.marked.get, self._remember_marked, []
            for i, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if i:
                    first = words.pop(0)
                    parts.append(get("\n") or make("\n"))
                    if first:
                        parts.append(get(first) or make(first))
                parts += [marked(w) or learn(w) for w in words]
            return np.frombuffer(b"".join(parts), self.m.width)
        return np.frombuffer(b"".join([get(u) or make(u) for u in self.units(self.normalized(text))]), self.m.width)

    def decode(self, ids) -> str:
        out = b"".join(map(self.surface.__getitem__, ids.tolist() if hasattr(ids, "tolist") else ids))
        text = out.decode("utf-8", "replace")
        return text[1:] if self.m.dummy_prefix and text[:1] == " " else text


def encode(docs: DataFrame, model: UnigramModel, text: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` without its text, with the id list ``name`` and ``round_trip``: whether decoding
    the ids gives the text again. Columns of these names are replaced."""
    keep = [c for c in docs.columns if c not in (text, name, "round_trip")]
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField(name, T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        e = Encoder(shipped.value)
        for batch in batches:
            for at, texts in text_slices(batch, text, 2_000_000):
                e.prepare(texts)
                ids = [e.encode(t) for t in texts]
                same = [e.decode(i) == (t or "") for i, t in zip(ids, texts, strict=True)]
                offsets = np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(texts)) for c in keep] + [lists, pa.array(same)],
                    names=[*keep, name, "round_trip"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: UnigramModel, ids: str = "ids", name: str = "text") -> DataFrame:
    """``encoded`` with the id list replaced by the decoded text; null ids give a null text."""
    keep = [c for c in encoded.columns if c not in (ids, name)]
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField(name, T.StringType())])
    shipped = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        e = Encoder(shipped.value)
        for batch in batches:
            texts = [None if i is None else e.decode(i) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(texts, pa.string())],
                                             names=[*keep, name])

    return encoded.select(*keep, ids).mapInArrow(run, schema)


@query("op6_sentencepiece")
def op6_sentencepiece(spark, sf_dir, model_file: str = MODEL_FILE):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, UnigramModel.load(spark, model_file)).selectExpr(
        "doc_id", "size(ids) as n_ids", "round_trip", "ids")
