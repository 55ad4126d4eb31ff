"""Repeated substrings by an enhanced suffix array and its common-prefix interval tree.

Texts are UTF-8 bytes; a repeat is a string of ``least`` (100) bytes or more that occurs twice, and
matches never cross documents.

Partitioning. Of the 20-byte strings in a window of ``least`` bytes the one with the smallest hash
is the window's anchor, so equal windows have equal anchors. A run of windows with one anchor is a
cell. Anchors that occur once cannot belong to a repeat; a count by anchor hash (pre-aggregated)
leaves the others. Cells with equal bytes are one class, represented by its first cell: all bytes
of a later copy are repeats. Only classes whose anchor has another class need their bytes compared.

Suffix arrays. Cells are gathered by anchor into chunks of about 2 MB. A task sorts the windows of
a chunk by the bytes up to the end of their cells (eight bytes a step, ties only), takes the common
prefixes of neighbours, and scans them with a stack: an interval of the array with common prefix l
is a node of the interval tree, and a repeat group of length l with all its occurrences. A node is
written as a group if its occurrences differ in the byte before them or stand at the start of a
cell; other nodes are part of the group one byte to the left. Occurrences are places of the array,
so that nested groups share them. Every occurrence that is not a group's first is removed.

An anchor with more than ``hot`` classes is split first. A window that begins x to y bytes before its
anchor holds x bytes before the anchor's start and ``least`` - y from there on, so the halves of that
range are parted by these bytes: equal windows still meet. The parts' cells are gathered like others;
equal ones are copies of the first, and a part that is still too large is halved again, down to
single windows.

Cells with equal bytes are found by hash (64-bit content hashes; parts of a split anchor by their
bytes) and do not enter the arrays more than once. Their ``copy`` rows complete the groups: an
occurrence in a cell with copies also stands, as far behind the cell's start, in every copy, and in
copies of these. A cell with its copies is itself a repeat group; if no other cell holds its windows,
there is no ``group`` row for it.

Defined cases: a null or empty text has no bytes; long texts are read whole; rows that repeat doc_id
and text are one document; different texts under one doc_id are documents of their own, in the order
of a hash (``doc`` is then a number of (doc_id, text) in that order instead of the doc_id); rows without
doc_id come after all others, equal texts among them being one document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.ranks import global_index
from shelfrank.llm.common import U64, mix64, table, text_slices, written
from shelfrank.llm.registry import query

ANCHOR = 20                  # bytes of an anchor
LAST = (1 << 63) - 1         # rows without doc_id get numbers below this one, by their texts
FEW = 500_000                # rows broadcast at most
SLICE = 250_000              # bytes of text handled at once: the arrays then stay in the CPU caches
_IDX = 28                    # bits of a position within a slice
_ODD = U64(0x9E3779B97F4A7C15 | 1)
_INV = U64(pow(int(_ODD), -1, 1 << 64))


def _words(buffer: np.ndarray, order: str = "<u8") -> np.ndarray:
    """The eight bytes from every position on, as a number; eight zero bytes follow the buffer."""
    padded = np.concatenate([buffer, np.zeros(16, np.uint8)])
    out = np.empty(len(buffer), U64)
    for r in range(8):
        part = padded[r:r + (len(buffer) + 8 - r) // 8 * 8].view(order)
        out[r::8] = part[:len(out[r::8])]
    return out


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def grow(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * SLICE)
            self.up = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n, _ODD))])
            self.down = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n, _INV))])
        return self.up[:n], self.down[:n]


def _anchor_hashes(buf: np.ndarray):
    """Hashes of the ANCHOR bytes from every position on, and the mixed words of the buffer."""
    w = _words(buf)
    mixed = mix64(w)
    m = len(buf) - ANCHOR + 1
    return mix64(w[:m] * U64(0xD6E8FEB86659FD93) + mixed[8:m + 8] + w[12:m + 12] * U64(0xA0761D6478BD642F)), mixed


def cells(raws: list[bytes], least: int, powers: Powers | None):
    """Arrays (document number in the list, start in the document, windows, anchor hash, content
    hash) of the cells of some texts; without ``powers`` the content hashes are left out (0)."""
    sizes = np.array([len(r) for r in raws], np.int64)
    buf = np.frombuffer(b"".join(raws), np.uint8)
    n = len(buf)
    starts = np.cumsum(sizes) - sizes
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, none, none, none
    h, mixed = _anchor_hashes(buf)
    m = len(h)
    key = ((h >> U64(_IDX)) << U64(_IDX)) | np.arange(m, dtype=U64)
    width = least - ANCHOR + 1
    low, span = key, 1
    while 2 * span <= width:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    low = np.minimum(low[:len(low) - (width - span)], low[width - span:])     # one per window start
    valid = np.ones(len(low), bool)
    for e in (starts + sizes)[:-1]:
        valid[max(0, e - least + 1):e] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, none, none
    anchor = (low[at] & U64((1 << _IDX) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)])
    lo, count = at[first], np.diff(np.r_[first, len(at)])
    if powers is None:
        content = np.zeros(len(lo), U64)
    else:
        up, down = powers.grow(n + 1)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixed * up[:n], dtype=U64)])
        content = mix64((sums[lo + count + least - 9 + 1] - sums[lo]) * down[lo] + count.astype(U64))
    doc = np.searchsorted(starts, lo, side="right") - 1
    while len(doc) and (sizes[doc] == 0).any():                                # empty texts share a start
        doc = np.where(sizes[doc] == 0, doc - 1, doc)
    return doc, lo - starts[doc], count, (h[anchor[first]] >> U64(16)).astype(np.int64), content.view(np.int64)


def _with_bytes(docs: DataFrame, make, schema: str, extra: list[str], text: str = "text") -> DataFrame:
    def run(batches):
        powers = Powers()
        for batch in batches:
            docnos = batch.column("doc")
            more = {c: batch.column(c) for c in extra}
            for at, texts in text_slices(batch, text, SLICE):
                raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
                yield from make(docnos.slice(at, len(raws)), raws, powers,
                                {c: v.slice(at, len(raws)) for c, v in more.items()})
    return docs.mapInArrow(run, schema)


def _find_cells(docs: DataFrame, least: int, anchors_only: bool = False) -> DataFrame:
    def make(docnos, raws, powers, _):
        doc, lo, n, h, c = cells(raws, least, None if anchors_only else powers)
        if anchors_only:
            yield pa.RecordBatch.from_arrays([pa.array(h)], names=["h"])
            return
        yield pa.RecordBatch.from_arrays(
            [docnos.take(pa.array(doc)), pa.array(lo * 256 + n), pa.array(h), pa.array(c)], names=["doc", "at", "h", "c"])

    if least - ANCHOR + 1 > 255:
        raise ValueError("least is at most 274")
    return _with_bytes(docs, make, "h long" if anchors_only else "doc long, at long, h long, c long", [])


def _document(key: str, text: str):
    """Number of a row's document: its key, or for rows without key one beyond all others."""
    none = F.lit(LAST) - F.coalesce(F.xxhash64(text), F.lit(0)).bitwiseAND((1 << 44) - 1)
    return F.coalesce(F.col(key).cast("long"), none)


def _few(df: DataFrame, weight: str) -> DataFrame:
    n, w = df.agg(F.count("*"), F.sum(weight)).first()
    return F.broadcast(df) if n <= FEW and (w or 0) <= 5 * FEW else df


class IntervalTree:
    """Enhanced suffix array of the windows of some cells, and its groups.

    ``blocks``: bytes of the cells; ``doc`` and ``start``: where each begins.
    """

    def __init__(self, blocks: list[bytes], doc: np.ndarray, start: np.ndarray, least: int):
        self.least = least
        sizes = np.array([len(b) for b in blocks], np.int64)
        buf = np.frombuffer(b"".join(blocks), np.uint8)
        begins = np.cumsum(sizes) - sizes
        windows = sizes - least + 1
        cell = np.repeat(np.arange(len(blocks)), windows)
        inside = np.arange(len(cell)) - np.repeat(np.cumsum(windows) - windows, windows)
        pos = begins[cell] + inside
        rest = sizes[cell] - inside
        word = _words(buf, ">u8")
        steps = int(sizes.max(initial=0) + 7) // 8

        def key(k: np.ndarray, step: int) -> np.ndarray:
            left = np.clip(rest[k] - 8 * step, 0, 8)
            shift = ((8 - left) * 8).astype(U64)
            v = word[np.minimum(pos[k] + 8 * step, len(word) - 1)]
            return np.where(left == 0, U64(0), (v >> np.minimum(shift, U64(63))) << np.minimum(shift, U64(63)))

        # order the windows by eight bytes a step; windows that differ from all others within
        # ``least`` bytes leave
        sure = least // 8                       # steps wholly inside every window
        k = np.arange(len(pos))
        group = np.zeros(len(k), np.int64)
        for step in range(steps):
            if not len(k):
                break
            v = key(k, step)
            o = np.lexsort((v, group)) if step else np.argsort(v, kind="stable")
            k, v, group = k[o], v[o], group[o]
            new = np.r_[True, (v[1:] != v[:-1]) | (group[1:] != group[:-1])]
            group = np.cumsum(new) - 1
            if step < sure:
                many = np.bincount(group)[group] > 1
                k, group = k[many], group[many]
        self.order = k
        self.doc, self.start = doc[cell[k]], start[cell[k]] + inside[k]
        self.before = np.where(inside[k] == 0, -1, buf[np.maximum(pos[k] - 1, 0)].astype(np.int64))
        # common prefixes of neighbours, capped at the shorter one
        lcp = np.zeros(len(k), np.int64)
        open_ = np.arange(1, len(k))
        for step in range(steps):
            if not len(open_):
                break
            x = key(k[open_], step) ^ key(k[open_ - 1], step)
            same = x == 0
            high = np.zeros(len(x), np.int64)
            for bits in (32, 16, 8):                          # whole leading zero bytes of x
                up = (x >> U64(64 - bits)) == 0
                high = np.where(up, high + bits // 8, high)
                x = np.where(up, x << U64(bits), x)
            lcp[open_] += np.where(same, 8, high)
            open_ = open_[same]
        if len(k):
            lcp[1:] = np.minimum(lcp[1:], np.minimum(rest[k[1:]], rest[k[:-1]]))
        self.lcp = lcp
        self._scan()

    def _scan(self) -> None:
        """Stack scan. groups: (length, low, high) of the left-diverse nodes; cover[i]: length of the
        longest group in which place i is not the first occurrence."""
        n, least = len(self.order), self.least
        self.groups: list[tuple[int, int, int]] = []
        cover = [0] * n
        rank = np.empty(n, np.int64)
        rank[np.lexsort((self.start, self.doc))] = np.arange(n)
        same = np.r_[False, (self.doc[1:] == self.doc[:-1]) & (self.start[1:] == self.start[:-1])] if n else []
        rank, lcp, before = rank.tolist(), self.lcp.tolist(), self.before.tolist()
        doc, start = self.doc.tolist(), self.start.tolist()
        del same
        stack: list[list] = []      # [length, low, first place, byte before (-2: several)]

        def join(node, first, byte):
            a, b = node[2], first
            if rank[b] < rank[a]:
                a, b = b, a
            if doc[a] != doc[b] or start[a] != start[b]:
                cover[b] = max(cover[b], node[0])
            node[2] = a
            if node[3] != byte or byte == -1:
                node[3] = -2

        for i in range(1, n + 1):
            length = lcp[i] if i < n else 0
            low, first, byte = i - 1, i - 1, before[i - 1]
            while stack and stack[-1][0] > length:
                node = stack.pop()
                join(node, first, byte)
                if node[3] == -2:
                    self.groups.append((node[0], node[1], i - 1))
                low, first, byte = node[1], node[2], node[3]
            if length >= least:
                if stack and stack[-1][0] == length:
                    join(stack[-1], first, byte)
                else:
                    stack.append([length, low, first, byte])
        self.cover = np.array(cover, np.int64)

    def spans(self):
        """Arrays (doc, start, length) of the occurrences that are not the first, merged where they touch."""
        some = np.flatnonzero(self.cover)
        return merged(self.doc[some], self.start[some], self.cover[some])


def merged(doc: np.ndarray, start: np.ndarray, length: np.ndarray):
    if not len(doc):
        return doc, start, length
    o = np.lexsort((start, doc))
    doc, start, end = doc[o], start[o], (start + length)[o]
    out_doc, out_start, out_end = [], [], []
    d = s = e = None
    for x, a, b in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True):
        if x == d and a <= e:
            e = max(e, b)
        else:
            if d is not None:
                out_doc.append(d), out_start.append(s), out_end.append(e)
            d, s, e = x, a, b
    out_doc.append(d), out_start.append(s), out_end.append(e)
    return np.array(out_doc), np.array(out_start), np.array(out_end) - np.array(out_start)


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text, doc): doc orders documents by doc_id and tells different texts under one doc_id apart."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    plain = rows.withColumn("doc", _document("id", "text"))
    n, distinct = rows.where("id is not null").agg(F.count("*"), F.count_distinct("id")).first()
    if n == distinct:
        return plain
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    places = written(rows.where("id is not null").select("id", own.alias("own")).distinct(), "documents-by-text")
    if places.count() == distinct:
        return plain
    numbers = written(global_index(places, ["id", "own"], "number"), "document-numbers").withColumnRenamed("id", "id_")
    return rows.join(numbers, (F.col("id") == F.col("id_")) & (own == F.col("own")), "left").select(
        "id", "text", F.coalesce("number", _document("id", "text")).alias("doc"))


def repeats(docs: DataFrame, least: int = 100, text: str = "text", key: str = "doc_id", hot: int = 100_000,
            chunk_bytes: int = 2_000_000, groups: bool = True) -> DataFrame:
    """Rows (kind, chunk, doc, start, length, low, high):

    - ``group``: a maximal repeat group: its length and the places low..high of its chunk's array
    - ``place``: place low of the array stands for (doc, start)
    - ``copy``: a cell of length bytes at (doc, start) equal to the one at (low = doc, high = start);
      copies complete the groups, as the module says
    - ``span``: bytes covered by an occurrence that is not its group's first

    With ``groups`` false only the spans are written. Groups reach at most to the end of their cell
    (``least`` + 80 bytes or fewer, less in a split anchor); a longer repeat is a chain of overlapping groups.
    """
    docs = _numbered(docs, key, text).select("doc", "text")
    found = _find_cells(docs, least)
    often = _find_cells(docs, least, anchors_only=True).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    cell = written(found.join(often, "h"), "cells")
    classes = written(cell.groupBy("h", "c").agg(F.min(F.struct("doc", "at")).alias("first"))
                      .select("h", "c", F.col("first.doc").alias("doc0"), F.col("first.at").alias("at0")), "cell-classes")
    start, size = F.shiftright("at", 8), F.col("at").bitwiseAND(255) + least - 1
    copies = (cell.join(classes, ["h", "c"]).where("doc <> doc0 or at <> at0")
              .select("doc", start.alias("start"), size.alias("length"), F.col("doc0").alias("low"),
                      F.shiftright("at0", 8).alias("high")))
    several = classes.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    # at: place and size as before, and a last bit for anchors of more than ``hot`` classes
    open_ = classes.join(several, "h").select("h", F.col("doc0").alias("doc"),
                                              (F.col("at0") * 2 + (F.col("m") > hot).cast("long")).alias("at"))
    need = written(open_.groupBy("doc").agg(F.collect_list("h").alias("hs"), F.collect_list("at").alias("ats"),
                                            F.count("*").alias("n")), "needs")
    with_need = docs.join(_few(need, "n"), "doc").select("doc", "text", "hs", "ats")

    def cut(docnos, raws, powers, more):
        d, s, h, m, b = [], [], [], [], []
        for doc, raw, hs, ats in zip(docnos.to_pylist(), raws, more["hs"].to_pylist(), more["ats"].to_pylist(), strict=True):
            for x, at in zip(hs, ats, strict=True):
                a, k = at >> 9, (at >> 1 & 255) + least - 1
                if a + k <= len(raw):
                    d.append(doc), s.append(a), h.append(x), m.append(bool(at & 1)), b.append(raw[a:a + k])
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
            (h, m, d, s, b), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
            names=["h", "frequent", "doc", "start", "bytes"])

    gathered = _with_bytes(with_need, cut, "h long, frequent boolean, doc long, start long, bytes binary", ["hs", "ats"])
    schema = "kind string, chunk long, doc long, start long, length long, low long, high long"
    common = gathered.where("not frequent").select("h", "doc", "start", "bytes")
    if several.where(F.col("m") > hot).limit(1).count():
        parts, equal = _split_anchors(gathered.where("frequent").select("h", "doc", "start", "bytes"), least, hot)
        common, copies = common.unionByName(parts), copies.unionByName(equal)
    grouped = common.repartition("h").sortWithinPartitions("h", "doc", "start")

    def scan(batches):
        for pdf in _chunks(batches, chunk_bytes):
            tree = IntervalTree(pdf["bytes"].tolist(), pdf["doc"].to_numpy(), pdf["start"].to_numpy(), least)
            chunk = int(pdf["h"].iloc[0])
            rows = [pd.DataFrame(dict(zip(("doc", "start", "length"), tree.spans(), strict=True))).assign(kind="span")]
            if groups and tree.groups:
                g = np.array(tree.groups)
                rows.append(pd.DataFrame({"length": g[:, 0], "low": g[:, 1], "high": g[:, 2]}).assign(kind="group"))
                rows.append(pd.DataFrame({"doc": tree.doc, "start": tree.start, "low": np.arange(len(tree.doc))}).assign(kind="place"))
            out = pd.concat(rows, ignore_index=True).assign(chunk=chunk)
            yield out.reindex(columns=["kind", "chunk", "doc", "start", "length", "low", "high"]).astype(
                dict.fromkeys(["doc", "start", "length", "low", "high"], "Int64"))

    out = grouped.mapInPandas(scan, schema)
    none = F.lit(None).cast("long")
    if groups:
        out = out.unionByName(copies.select(F.lit("copy").alias("kind"), none.alias("chunk"), "doc", "start", "length", "low", "high"))
    return out.unionByName(copies.select(F.lit("span").alias("kind"), none.alias("chunk"), "doc", "start", "length",
                                         none.alias("low"), none.alias("high")))


def _chunks(batches, chunk_bytes: int):
    """Whole anchors of a sorted partition, gathered to about ``chunk_bytes``."""
    held, size = [], 0
    for pdf in batches:
        while len(pdf):
            sizes = pdf["bytes"].map(len).to_numpy().cumsum()
            if size + sizes[-1] < chunk_bytes:
                held.append(pdf)
                size += int(sizes[-1])
                break
            # cut behind the anchor that fills the chunk
            k = int(np.searchsorted(sizes, chunk_bytes - size))
            h = pdf["h"].to_numpy()
            if held and h[0] == held[-1]["h"].iloc[-1] and k == 0:
                k = 0
            end = int(np.searchsorted(h[k:], h[min(k, len(h) - 1)] + 1)) + k
            held.append(pdf.iloc[:end])
            if end == len(pdf):
                size += int(sizes[-1])      # the anchor may go on in the next batch
                break
            yield pd.concat(held, ignore_index=True)
            held, size, pdf = [], 0, pdf.iloc[end:]
    if held:
        yield pd.concat(held, ignore_index=True)


def _anchor_offsets(blocks: list[bytes], least: int) -> np.ndarray:
    """Where each cell's anchor stands: the first of the lowest keys in its first window."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    h, _ = _anchor_hashes(np.frombuffer(b"".join(blocks), np.uint8))
    inside = (np.cumsum(sizes) - sizes)[:, None] + np.arange(least - ANCHOR + 1)
    return (h >> U64(_IDX))[inside].argmin(1)


def _split_anchors(rows: DataFrame, least: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """(cells, copies) of the parts of some anchors' cells. The cells (h, doc, start, bytes) differ
    within their part, named h, and are at most ``hot`` there; copies as in ``repeats``."""
    def halves(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            out = [[] for _ in range(6)]
            names = ("h", "doc", "start", "bytes", "x", "y")
            columns = [batch.column(c).to_pylist() for c in names]
            for h, doc, start, b, low, high, p in zip(*columns, _anchor_offsets(columns[3], least).tolist(), strict=True):
                middle = (low + high) // 2
                for x, y in ((low, middle), (middle + 1, high)):
                    i, j = max(0, p - y), min(len(b) - least, p - x)      # windows x to y bytes before the anchor
                    if i <= j:
                        part = hashlib.blake2b(b"%d %d %d " % (h, x, y) + b[p - x:p - y + least], digest_size=6).digest()
                        for o, v in zip(out, (int.from_bytes(part, "little"), doc, start + i,
                                              b[i:j + least], x, y), strict=True):
                            o.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], names=list(names))

    rows = rows.select("*", F.lit(0).alias("x"), F.lit(least - ANCHOR).alias("y"))
    done, copies, part = [], [], ["h", "x", "y"]
    while True:
        pieces = written(rows.mapInArrow(halves, "h long, doc long, start long, bytes binary, x int, y int"), "hot-pieces")
        classes = written(pieces.groupBy(*part, "bytes").agg(F.min(F.struct("doc", "start")).alias("first")), "hot-classes")
        copies.append(pieces.join(classes, [*part, "bytes"]).where("doc <> first.doc or start <> first.start")
                      .select("doc", "start", F.octet_length("bytes").cast("long").alias("length"),
                              F.col("first.doc").alias("low"), F.col("first.start").alias("high")))
        many = classes.groupBy(*part).agg(F.count("*").alias("m")).where("m > 1")
        sized = written(classes.join(many, part).select("h", F.col("first.doc").alias("doc"), F.col("first.start").alias("start"),
                                                        "bytes", "x", "y", "m"), "hot-parts")
        large = (F.col("m") > hot) & (F.col("x") < F.col("y"))
        done.append(sized.where(~large).select("h", "doc", "start", "bytes"))
        rows = sized.where(large).drop("m")
        if rows.isEmpty():
            return functools.reduce(DataFrame.unionByName, done), functools.reduce(DataFrame.unionByName, copies)


def without_repeats(docs: DataFrame, spans: DataFrame, text: str = "text", key: str = "doc_id",
                    digest: bool = False) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans and the remaining bytes (``kept``), or their sha256
    with ``digest``."""
    at = spans.where("kind = 'span'").groupBy("doc").agg(
        F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))

    def merge(batches):
        """A document's spans, merged where they touch or overlap."""
        for batch in batches:
            starts, lengths = [], []
            for a, b in zip(batch.column("starts"), batch.column("lengths"), strict=True):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                _, x, y = merged(np.zeros(len(a), np.int64), a, b)
                starts.append(x), lengths.append(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(starts, pa.list_(pa.int64())), pa.array(lengths, pa.list_(pa.int64())),
                 pa.array([len(x) for x in starts], pa.int64())], names=["doc", "starts", "lengths", "n"])

    at = written(at.mapInArrow(merge, "doc long, starts array<long>, lengths array<long>, n long"), "spans-of-documents")
    rows = _numbered(docs, key, text).join(_few(at, "n"), "doc", "left").select("doc", "id", "text", "starts", "lengths")
    last = "kept_sha256 string" if digest else "kept binary"

    def make(docnos, raws, powers, more):
        out = [[] for _ in range(4)]
        for raw, start, length in zip(raws, more["starts"].to_pylist(), more["lengths"].to_pylist(), strict=True):
            start, kept, i = start or [], [], 0
            for s, n in zip(start, length or [], strict=True):
                kept.append(raw[i:s])
                i = s + n
            kept = b"".join([*kept, raw[i:]])
            for o, v in zip(out, (len(raw), len(raw) - len(kept), len(start),
                                  hashlib.sha256(kept).hexdigest() if digest else kept), strict=True):
                o.append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary())
        yield pa.RecordBatch.from_arrays([more["id"], *[pa.array(o, t) for o, t in zip(out, types, strict=True)]],
                                         names=[key, "n_bytes", "n_removed", "n_spans", last.split()[0]])

    return _with_bytes(rows, make, f"{key} long, n_bytes long, n_removed long, n_spans long, {last}", ["id", "starts", "lengths"])


@query("op2_interval_tree")
def op2_interval_tree(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return without_repeats(docs, repeats(docs, groups=False), digest=True)
