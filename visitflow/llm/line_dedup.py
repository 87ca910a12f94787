"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, union-find."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, Scratch, first_copy, fresh, row_key, small_batches, text_hash, with_row_key
from .components import components

SHINGLE = 9                # characters; a shorter line is one shingle
NEAR_SHINGLE = 5           # characters in op1 and the pipeline: one changed character spoils 5 shingles, not 9
SIMILARITY = 0.8
RECALL = 0.997             # least probability with which a pair of similarity SIMILARITY shares a band
ROWS = 5                   # values of a band; for much larger corpora more, and bands_for adds bands
BLOCK_LINES = 1024         # lines of a bucket compared with as many others in one group
SEEN_LINES = 200_000       # line keys a task remembers, so that it signs a repeated line once
SEEN_SHINGLES = 1 << 21    # shingles a task remembers from one group of lines to the next: 16 MB
CHUNK_CHARS = 1 << 16      # characters signed at a time: their arrays stay in the cache
BAND_PARTS = 4096          # bands are dealt into so many parts, each grouped by one task: 8 MB of rows at 30 GB of text
SIZE_BITS = 16             # of a band row for the line's size; 48 tell bands apart
SIZES = (1 << SIZE_BITS) - 1
BAND_ROWS = 1 << 21        # band rows a task packs at a time: 32 MB
CLOSE_PAIRS = 1 << 15      # pairs whose sketches meet at a time
SKETCH_BITS = 1024         # of the bitmap by which two lines are told apart before their shingles are compared
FILTER_BITS = 1 << 26      # bits of the filter for lines to verify: 8 MB at any corpus size
BASE = 0x9E3779B97F4A7C15
WRAP = (1 << 64) - 1


def bands_for(rows: int, similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` values that a pair of ``similarity`` shares one of with probability ``recall``."""
    if similarity >= 1:
        return 1
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))


BANDS = bands_for(ROWS)    # 15: a pair of Jaccard 0.8 is found with probability 0.997, of 0.9 with 0.9999, of 0.1 with 0.0002


def line_key(line: str) -> int:
    """Spark's xxhash64 of the line, as a signed long."""
    h = xxhash.xxh64_intdigest(line.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """Numbered lines that hold a word."""
    return [(i, line) for i, line in enumerate(text.split("\n")) if line.strip(SPACE_CHARS)] if text else []


def shingles(line: str, width: int = SHINGLE) -> set[str]:
    return {line[i:i + width] for i in range(max(1, len(line) - width + 1))}


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def similar(a: set, b: set, least: float) -> bool:
    """Whether the Jaccard similarity is ``least`` or more; sizes too far apart settle it at once."""
    small, large = sorted((len(a), len(b)))
    return small >= least * large - 1e-9 and jaccard(a, b) >= least      # 0.8 * 35 > 28 in floating point


def shingle_ids(line: str, width: int) -> np.ndarray | set[str]:
    """The shingles as sorted distinct integers that name them exactly; as a set if a character needs too many bits.

    A character takes 64 // width bits (12 at width 5) and is never 0, so that a line shorter than a shingle
    equals no other.
    """
    bits = 64 // width
    cp = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    if not bits or int(cp.max(initial=0)) + 1 >> bits:
        return shingles(line, width)
    n = places(line, width)
    cp = cp.astype(np.uint64)
    cp += np.uint64(1)
    if len(cp) < width:
        cp = np.append(cp, np.zeros(width - len(cp), np.uint64))
    ids = cp[:n].copy()
    for k in range(1, width):
        ids <<= np.uint64(bits)
        ids |= cp[k:k + n]
    ids.sort()
    new = np.ones(n, bool)
    np.not_equal(ids[1:], ids[:-1], out=new[1:])
    return ids[new]


def _spelled(ids: np.ndarray | set[str], width: int) -> set[str]:
    """The shingles of ``shingle_ids`` as strings."""
    if isinstance(ids, set):
        return ids
    bits = 64 // width
    chars = [[x >> bits * k & (1 << bits) - 1 for k in reversed(range(width))] for x in ids.tolist()]
    return {"".join(chr(c - 1) for c in shingle if c) for shingle in chars}


def similar_ids(a: np.ndarray | set[str], b: np.ndarray | set[str], least: float, width: int) -> bool:
    """``similar`` for the results of ``shingle_ids``."""
    if isinstance(a, set) or isinstance(b, set):
        return similar(_spelled(a, width), _spelled(b, width), least)
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1e-9:
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(a) + len(b) - common) >= least


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return x


def _shingle_hashes(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of lines; line number and hash of every shingle. Lines shorter than ``width`` have none here."""
    n = np.fromiter(map(len, lines), np.int64, len(lines))
    text = "".join(lines)
    total = len(text)
    cp = np.zeros(total + width + 8, np.uint64)
    np.add(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.uint64(1), out=cp[:total], dtype=np.uint64)
    h, power, have = cp, BASE, 1
    for step in (1, 2, 4):                       # hashes of 2, 4, 8 characters, then the rest one by one
        if 2 * step > width:
            break
        longer = h[step:] * np.uint64(power)
        longer += h[:len(h) - step]
        h, power, have = longer, power * power & WRAP, have * 2
    h = h[:total]
    for k in range(have, width):
        h = h + np.uint64(power) * cp[k:k + total]
        power = power * BASE & WRAP
    whole = np.ones(total, bool)                 # shingles inside their line: not the last width - 1 places
    ends = np.cumsum(n)
    for k in range(1, width):
        whole[(ends - k)[n >= k]] = False
    line = np.repeat(np.arange(len(lines)), np.maximum(n - width + 1, 0))
    return n, line, _mix(h[whole])


def _packed_sketches(lines: list[str], width: int) -> np.ndarray:
    """A row of SKETCH_BITS / 8 bytes for each line."""
    out = np.zeros((len(lines), SKETCH_BITS // 8), np.uint8)
    at = 0
    while at < len(lines):
        end, size = at, 0
        while end < len(lines) and (end == at or size + len(lines[end]) <= CHUNK_CHARS):
            size += len(lines[end])
            end += 1
        chunk = lines[at:end]
        n, line, h = _shingle_hashes(chunk, width)
        bits = np.zeros((len(chunk), SKETCH_BITS), bool)
        bits.reshape(-1)[line * SKETCH_BITS + (h & np.uint64(SKETCH_BITS - 1)).astype(np.int64)] = True
        for i in np.flatnonzero(n < width).tolist():
            bits[i, xxhash.xxh32_intdigest(chunk[i].encode()) % SKETCH_BITS] = True
        out[at:end] = np.packbits(bits, axis=1)
        at = end
    return out


def sketches(lines: list[str], width: int) -> list[int]:
    """A bitmap of each line's shingles, as an integer: equal shingles have equal bits."""
    return [int.from_bytes(row.tobytes(), "big") for row in _packed_sketches(lines, width)]


def apart(x: int, y: int, places: int, least: float) -> bool:
    """Whether sketches prove a Jaccard similarity below ``least``; ``places`` is at least the sizes' sum.

    A bit of only one sketch stands for a shingle of only one line, and at a
    similarity of s at most (1 - s) / (1 + s) of the sizes' sum are such.
    """
    return (x ^ y).bit_count() * (1 + least) > places * (1 - least) + 1e-6


def places(line: str, width: int) -> int:
    return max(1, len(line) - width + 1)


@cache
def _detours(bins: int) -> np.ndarray:
    """Row t: the bin from which each empty bin takes its value at attempt t. Each column passes through all bins."""
    spots = np.arange(bins, dtype=np.uint64)
    order = _mix(spots[:, None] * np.uint64(BASE) + spots[None, :] + np.uint64(1 << 20))
    return np.argsort(order, axis=0, kind="stable")


def sign(lines: list[str], bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> np.ndarray:
    """Band hashes of lines: a MinHash with one value for each of bands * rows bins (one permutation).

    Each shingle's hash falls in one bin; a bin keeps its least. An empty bin
    takes the value of the first filled one on a path of its own (``_detours``),
    and the bins of a band lie far apart, so that the values of a short line's
    band are as independent as those of a long one.
    """
    return _signed(lines, bands, rows, width)[0]


def _signed(lines: list[str], bands: int, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``sign``, and the number of different shingles of each line (at most 2^16 lines)."""
    bins = bands * rows
    n, line, h = _shingle_hashes(lines, width)
    named = h >> np.uint64(16)
    named |= line.view(np.uint64) << np.uint64(48)
    named.sort()                                 # line after line, as before
    new = np.ones(len(named), np.int32)
    np.not_equal(named[1:], named[:-1], out=new[1:], casting="unsafe")
    sizes = np.ones(len(lines), np.int64)
    count = np.maximum(n - width + 1, 0)
    whole = np.flatnonzero(count)
    if len(whole):
        sizes[whole] = np.add.reduceat(new, (np.cumsum(count) - count)[whole])
    where = h >> np.uint64(32)
    where *= np.uint64(bins)
    where >>= np.uint64(32)
    where = where.view(np.int64)
    where += line * bins
    sig = np.full(len(lines) * bins, np.iinfo(np.uint64).max, np.uint64)
    h &= np.uint64(0xFFFFFFFF)
    np.minimum.at(sig, where, h)
    sig = sig.reshape(len(lines), bins)
    short = np.flatnonzero(n < width)
    if len(short):
        sig[short] = np.array([[xxhash.xxh32_intdigest(lines[i].encode())] for i in short.tolist()], np.uint64)
    at, gap = np.nonzero(sig == np.iinfo(np.uint64).max)
    full = sig.copy()
    for path in _detours(bins):
        if not len(at):
            break
        value = sig[at, path[gap]]
        hit = value != np.iinfo(np.uint64).max
        full[at[hit], gap[hit]] = value[hit]
        at, gap = at[~hit], gap[~hit]
    out = np.zeros((len(lines), bands), np.uint64)
    for r in range(rows):
        out = _mix(out + full[:, r * bands:(r + 1) * bands] + np.uint64(r + 1))
    return _mix(out + np.arange(bands, dtype=np.uint64) * np.uint64(BASE)).view(np.int64), sizes


def _pack_bands(bands: int, rows: int, width: int):
    """Texts -> (part, rows): the (band, key) pairs of a part's bands as bytes, from lines the task meets first.

    The last SIZE_BITS bits of a band give way to the line's number of shingles.
    """
    def packed(keys: list[int], signed: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        band = np.concatenate([b for b, _ in signed])
        size = np.concatenate([n for _, n in signed])
        band = ((band & ~SIZES) | np.minimum(size, SIZES)[:, None]).reshape(-1)
        part = band >> SIZE_BITS & (BAND_PARTS - 1)
        order = np.argsort(part.astype(np.int16), kind="stable")
        both = np.stack([band[order], np.repeat(np.array(keys, np.int64), bands)[order]], axis=1)
        ends = np.cumsum(np.bincount(part, minlength=BAND_PARTS))
        full = np.flatnonzero(np.diff(ends, prepend=0))
        starts = np.append(0, ends)[full]
        return pd.DataFrame({"part": full.astype(np.int32),
                             "rows": [both[a:b].tobytes() for a, b in zip(starts.tolist(), ends[full].tolist())]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        keys, signed, chunk, size = [], [], [], 0
        for b in batches:
            for text in b["text"]:
                for _, line in lines_of(text):
                    key = line_key(line)
                    if key in seen:
                        continue
                    if len(seen) >= SEEN_LINES:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    chunk.append(line)
                    size += len(line)
                    if size >= CHUNK_CHARS:
                        signed.append(_signed(chunk, bands, rows, width))
                        chunk, size = [], 0
                        if len(keys) * bands >= BAND_ROWS:
                            yield packed(keys, signed)
                            keys, signed = [], []
        if chunk:
            signed.append(_signed(chunk, bands, rows, width))
        if keys:
            yield packed(keys, signed)
    return run


def _unpack_bands(similarity: float):
    """Rows of ``_pack_bands`` sorted by part -> (band, key), sorted, one whole part after the other.

    Without the lines whose size is too far from that of every other line of their band.
    """
    def rows(held: list[bytes]) -> pd.DataFrame:
        both = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
        both = both[np.argsort(both[:, 0])]                     # by band, then size
        band, size = both[:, 0] & ~SIZES, both[:, 0] & SIZES
        # one more than counted, should two shingles of a line have had one hash
        fits = (band[1:] == band[:-1]) & (size[:-1] + 1 >= similarity * size[1:] - 1e-9)
        keep = np.append(fits, False) | np.append(False, fits) if len(band) else np.zeros(0, bool)
        band, key = band[keep], both[keep, 1]
        order = np.lexsort((key, band))
        return pd.DataFrame({"band": band[order], "key": key[order]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for b in batches:
            for part, packed in zip(b["part"].tolist(), b["rows"]):
                if part != at:
                    if held:
                        yield rows(held)
                    at, held = part, []
                held.append(packed)
        if held:
            yield rows(held)
    return run


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (band, key) -> members of bands with several lines, each with the band's first line.

    ``pair``: the band surely has no third line, so that the two need no other comparison than that with the first.
    """
    last_band, rep, told, last_key = None, 0, False, None
    for b in batches:
        band, key = b["band"].to_numpy(), b["key"].to_numpy()
        if not len(band):
            continue
        new = np.append(True, (band[1:] != band[:-1]) | (key[1:] != key[:-1]))
        new[0] = last_band is None or band[0] != last_band or key[0] != last_key
        band, key = band[new], key[new]
        if not len(band):
            continue
        start = np.append(band[0] != last_band if last_band is not None else True, band[1:] != band[:-1])
        first = np.maximum.accumulate(np.where(start, np.arange(len(band)), -1))
        reps = np.where(first >= 0, key[np.maximum(first, 0)], rep)
        follows = ~start
        needs_rep = np.append(follows[1:] & start[:-1], False)      # a first row with a second one in this batch
        keep = follows | needs_rep
        group = np.cumsum(start)                                    # 0: continues the batch before
        pair = (np.bincount(group)[group] == 2) & (group > 0) & (group < group[-1])
        rows = pd.DataFrame({"band": band[keep], "rep": reps[keep], "key": key[keep], "pair": pair[keep]})
        if follows[0] and not told:                                 # the first row was the last of the batch before
            rows = pd.concat([rows, pd.DataFrame({"band": [band[0]], "rep": [rep], "key": [rep], "pair": [False]})],
                             ignore_index=True)
        yield rows
        told = bool(follows[-1])
        last_band, last_key, rep = band[-1], key[-1], int(reps[-1])


def _texts(bitmap: np.ndarray, width: int):
    """(doc_id, text_key, text) -> a row of each document with a line, with number and key of its lines with a word;
    and lines whose key the filter holds, with sketch and number of shingle places, once for each task and line."""
    bits = len(bitmap) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for b in batches:
            numbers, listed, ends, met = [], [], [0], []
            for text in b.column("text").to_pylist():
                for i, line in lines_of(text):
                    numbers.append(i)
                    listed.append(line_key(line))
                    met.append(line)
                ends.append(len(numbers))
            listed = np.array(listed, np.int64)
            slot = listed & (bits - 1)
            keys, lines = [], []
            for at in np.flatnonzero(bitmap[slot >> 3] >> (slot & 7) & 1).tolist():
                key = int(listed[at])
                if key not in sent:
                    if len(sent) >= SEEN_LINES:
                        sent.clear()
                    sent.add(key)
                    keys.append(key)
                    lines.append(met[at])
            of_docs = [b.column("doc_id"), b.column("text_key"),
                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32())),
                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(listed))]
            of_lines = [pa.array(keys, pa.int64()), pa.array(lines, pa.string()),
                        pa.array([row.tobytes() for row in _packed_sketches(lines, width)], pa.binary()),
                        pa.array([places(x, width) for x in lines], pa.int32())]
            names = ["doc_id", "text_key", "lines", "keys", "key", "text", "sketch", "places"]
            yield pa.RecordBatch.from_arrays([*of_docs, *[pa.nulls(b.num_rows, c.type) for c in of_lines]], names)
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(keys), c.type) for c in of_docs], *of_lines], names)
    return run


def _filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of ``keys`` modulo FILTER_BITS, made by Spark's bitmap aggregates: at most 2048 rows of 4 KB."""
    slot = F.pmod("key", F.lit(FILTER_BITS).cast("long"))
    rows = (keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)
    for r in rows:                # value v is bit (v - 1) mod 32768 of bucket 1 + (v - 1) div 32768; 0 is in bucket 0
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        base = (r["bucket"] - 1) * 32768 + 1 if r["bucket"] > 0 else None
        if base is None:
            out[0] |= 1
            continue
        values = base + np.flatnonzero(np.unpackbits(part, bitorder="little"))
        np.bitwise_or.at(out, values >> 3, (1 << (values & 7)).astype(np.uint8))
    return out[:FILTER_BITS // 8]


def _words(sketch: pd.Series) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(sketch), np.uint64).reshape(len(sketch), SKETCH_BITS // 64)


def _plausible(similarity: float):
    """Pairs whose sketches do not prove them apart."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            differ = np.bitwise_count(_words(b["sketch"]) ^ _words(b["rep_sketch"])).sum(axis=1, dtype=np.int64)
            size = (b["places"] + b["rep_places"]).to_numpy()
            yield b.loc[differ * (1 + similarity) <= size * (1 - similarity) + 1e-6, ["rep", "key"]]
    return run


def _verify(similarity: float, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, base = None, None
        for b in batches:
            keep = []
            for rep, a, c in zip(b["rep"].tolist(), b["rep_text"], b["text"]):
                if rep != at:
                    at, base = rep, shingle_ids(a, width)
                keep.append(similar_ids(base, shingle_ids(c, width), similarity, width))
            yield pd.DataFrame({"u": b["rep"][keep], "v": b["key"][keep]})
    return run


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows with those of a (band, i, j) together -> frames of whole groups, each with the start of every row's group."""
    def starts(frame: pd.DataFrame) -> np.ndarray:
        names = frame[["band", "i", "j"]].to_numpy()
        new = np.append(True, (names[1:] != names[:-1]).any(axis=1))
        return np.maximum.accumulate(np.where(new, np.arange(len(frame)), 0))
    held = None
    for b in batches:
        held = b if held is None else pd.concat([held, b], ignore_index=True)
        if not len(held):
            continue
        start = starts(held)
        last = int(start[-1])
        if last:
            yield held[:last], start[:last]
            held = held[last:].reset_index(drop=True)
    if held is not None and len(held):
        yield held, starts(held)


def _close(frame: pd.DataFrame, start: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (n, m), m < n in one group, of lines of different classes whose sketches do not prove them apart."""
    cls, side, size = (frame[c].to_numpy() for c in ("cls", "side", "places"))
    words = _words(frame["sketch"])
    before = np.arange(len(frame)) - start
    total = np.cumsum(before)
    row = 0
    while row < len(frame):
        end = max(row + 1, int(np.searchsorted(total, (total[row - 1] if row else 0) + CLOSE_PAIRS, side="right")))
        count = before[row:end]
        n = np.repeat(np.arange(row, end), count)
        m = np.arange(len(n)) - np.repeat(np.cumsum(count) - count, count) + start[n]
        meet = (cls[n] != cls[m]) & ((side[n] != side[m]) | (side[n] == 2))
        n, m = n[meet], m[meet]
        differ = np.bitwise_count(words[n] ^ words[m]).sum(axis=1, dtype=np.int64)
        near = differ * (1 + similarity) <= (size[n] + size[m]) * (1 - similarity) + 1e-6
        yield n[near], m[near]
        row = end


def _near(similarity: float):
    """Rows of whole groups (band, i, j), sorted -> those that may be similar to one of another class in the group."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, start in _whole_groups(batches):
            keep = np.zeros(len(frame), bool)
            for n, m in _close(frame, start, similarity):
                keep[n] = keep[m] = True
            yield frame.loc[keep, ["rep", "band", "i", "j", "side", "key", "cls"]]
    return run


def _cross(similarity: float, width: int):
    """Rows of whole groups (band, i, j), sorted -> links between different classes of a group.

    Classes that a link of the task has joined are not compared again, nor are lines that it has found apart.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}
        failed: set[tuple[int, int]] = set()
        sets: dict[int, np.ndarray | set[str]] = {}

        def find(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x
        for frame, start in _whole_groups(batches):
            if max(len(parent), len(failed)) >= SEEN_LINES:
                parent.clear()
                failed.clear()
            if sum(map(len, sets.values())) >= SEEN_SHINGLES:
                sets.clear()
            cls, key, text, links = frame["cls"].tolist(), frame["key"].tolist(), frame["text"].tolist(), []

            def ids(n: int) -> np.ndarray | set[str]:
                if key[n] not in sets:
                    sets[key[n]] = shingle_ids(text[n], width)
                return sets[key[n]]
            for rows, others in _close(frame, start, similarity):
                for n, m in zip(rows.tolist(), others.tolist()):
                    a, b = find(cls[n]), find(cls[m])
                    pair = (key[n], key[m]) if key[n] < key[m] else (key[m], key[n])
                    if a == b or pair in failed:
                        continue
                    if similar_ids(ids(n), ids(m), similarity, width):
                        parent[a] = b
                        links.append((cls[n], cls[m]))
                    else:
                        failed.add(pair)
            yield pd.DataFrame(links, columns=["u", "v"]).astype("int64")
    return run


def line_classes(docs: DataFrame, scratch: Scratch, similarity: float = SIMILARITY, width: int = SHINGLE,
                 bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, text) -> (doc_id, text_key, n_lines, line, key) of every line with a word, ``n_lines`` being
    their number in the text; and (key, component) of the lines in classes of two different lines or more.

    First every line is verified against the first line of each of its bands
    (a star, not all pairs), and union-find joins what is similar. Then only
    bands of three lines or more that still hold lines of different classes
    are gone through, class against class, in blocks of BLOCK_LINES, so every
    pair that shares a band is either in one class already or compared.
    Band rows are shuffled in packed parts, never stored. Each line of a band
    of several is sketched once a task; sketches meet first, and texts only of
    those lines that a sketch does not tell apart from all others.
    """
    packed = (docs.select("text").mapInPandas(_pack_bands(bands, rows, width), "part int, rows binary")
              .repartition("part").sortWithinPartitions("part"))
    unpack = _unpack_bands(similarity)
    stars = scratch.write(packed.mapInPandas(lambda parts: _stars(unpack(parts)),
                                             "band long, rep long, key long, pair boolean"), "stars")
    needed = _filter(stars.select("key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = scratch.write(docs.select("doc_id", "text_key", "text").mapInArrow(
        _texts(needed, width), f"doc_id {kind}, text_key long, lines array<int>, keys array<long>, "
                               "key long, text string, sketch binary, places int"), "texts")
    listed = (stored.where("lines IS NOT NULL")
              .select("doc_id", "text_key", F.size("lines").alias("n_lines"), F.inline(F.arrays_zip("lines", "keys")))
              .withColumnsRenamed({"lines": "line", "keys": "key"}))
    found = stored.where("key IS NOT NULL").select("key", "text", "sketch", "places")
    # of lines with one key (equal lines, met by several tasks) one is enough
    sketched = found.select("key", "sketch", "places").repartition("key").groupBy("key").agg(
        F.any_value("sketch").alias("sketch"), F.any_value("places").alias("places"))

    def found_of(keys: DataFrame, columns: list[str], name: str) -> DataFrame:
        wanted = found.select("key", *columns).join(keys.distinct(), "key", "left_semi")
        return scratch.write(wanted.groupBy("key").agg(*[F.any_value(c).alias(c) for c in columns]), name)

    def of_rep(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c).alias("rep" if c == "key" else f"rep_{c}") for c in rows.columns])

    pairs = stars.where("rep != key").select("rep", "key").repartition("key").distinct()
    pairs = pairs.join(sketched, "key").join(of_rep(sketched), "rep")
    pairs = scratch.write(pairs.mapInPandas(_plausible(similarity), "rep long, key long"), "pairs")
    written = found_of(pairs.select("key").union(pairs.select("rep")), ["text"], "pair_texts")
    links = pairs.join(written, "key").join(of_rep(written), "rep").sortWithinPartitions("rep")
    links = scratch.write(links.mapInPandas(_verify(similarity, width), "u long, v long"), "links")
    scratch.drop(pairs)
    scratch.drop(written)
    first = scratch.write(components(links, scratch), "first")
    scratch.drop(links)

    def classed(rows: DataFrame, classes: DataFrame) -> DataFrame:
        return (rows.join(classes.select(F.col("node").alias("key"), "component"), "key", "left")
                .withColumn("cls", F.coalesce("component", "key")).drop("component"))

    members = classed(stars.where("NOT pair").select("band", "rep", "key"), first)
    mixed = (members.groupBy("band").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), F.count("*").alias("n"))
             .where("low != high AND n > 2").select("band", F.ceil(F.col("n") / BLOCK_LINES).alias("parts")))
    bands = scratch.write(mixed, "mixed_bands")
    mixed = scratch.write(members.join(bands, "band").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts"))), "mixed")
    scratch.drop(bands)
    scratch.drop(stars)
    # every block meets itself (side 2) and each other block (sides 0 and 1)
    dealt = mixed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select("rep", "band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                         F.expr("CASE WHEN part = other THEN 2L WHEN part < other THEN 0L ELSE 1L END").alias("side"),
                         "key", "cls")
    near = (dealt.join(sketched, "key").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
            .mapInPandas(_near(similarity), "rep long, band long, i long, j long, side long, key long, cls long"))
    near = scratch.write(near, "near")
    scratch.drop(mixed)
    written = found_of(near.select("key"), ["text", "sketch", "places"], "near_texts")
    # bands of one first line hold much the same lines: a task goes through a quarter of them and remembers what it compared
    more = (near.join(written, "key").repartition("rep", "i", "j", F.pmod(F.xxhash64("band"), F.lit(4)))
            .sortWithinPartitions("rep", "i", "j", "band", "cls", "key")
            .mapInPandas(_cross(similarity, width), "u long, v long"))
    more = scratch.write(more, "more")
    scratch.drop(near)
    scratch.drop(written)
    if more.isEmpty():
        return listed, first.select(F.col("node").alias("key"), "component")
    second = components(more, scratch).select(F.col("node").alias("cls"), F.col("component").alias("top"))
    joined = first.join(second, first["component"] == second["cls"], "left").select(
        "node", F.coalesce("top", "component").alias("component"))
    # classes of one line that the second round joined are not in the first round's table
    alone = second.join(first, second["cls"] == first["node"], "left_anti").select(
        F.col("cls").alias("node"), F.col("top").alias("component"))
    return listed, scratch.write(joined.unionByName(alone).select(F.col("node").alias("key"), "component"), "classes")


def duplicate_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    bands: int | None = None, rows: int = ROWS, width: int = SHINGLE, name: str = "lines") -> DataFrame:
    """(doc_id, text_key, line, component, kept, kept_doc, kept_line) of every line with a word.

    Lines are similar at a Jaccard similarity of ``similarity`` or more of
    their sets of ``width``-character shingles. Without ``bands`` there are as
    many as ``bands_for`` gives, so more rows cost no recall. Of each class (component, its
    smallest line key) one line is kept: the one of the smallest (doc_id,
    nulls last; text_key; line), named by kept_doc and kept_line. Equal lines
    are one node, so a line that a third of all documents share costs one row
    per line. ``text_key`` tells documents with one id apart; rows that
    repeat both id and text have the same lines, listed for each.

    Lines without a word are never duplicates and not listed; null and empty
    texts have none; an empty table gives no rows. Other columns are ignored.
    Two different lines whose 64-bit keys collide (one pair in 10^19) would
    count as equal.
    """
    lines, grouped = _classed_lines(df, doc_id, text, similarity, bands, rows, width, name)
    alone = lines.where("component IS NULL").select(
        "doc_id", "text_key", "line", F.col("key").alias("component"), F.lit(True).alias("kept"),
        F.col("doc_id").alias("kept_doc"), F.col("line").alias("kept_line"))
    return grouped.unionByName(alone)


def _classed_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                   bands: int | None = None, rows: int = ROWS, width: int = SHINGLE, name: str = "lines"
                   ) -> tuple[DataFrame, DataFrame]:
    """Every line with a word, its component null if it is the only line of its class; ``duplicate_lines`` of the others."""
    scratch = Scratch(df.sparkSession, name, tidy=True)
    bands = bands or bands_for(rows, similarity)
    small_batches(df.sparkSession)
    docs = df.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_key"), F.col(text).alias("text"))
    listed, classes = line_classes(docs, scratch, similarity, width, bands, rows)
    several = listed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    several = several.join(classes, "key", "full").select("key", F.coalesce("component", "key").alias("component"))
    lines = scratch.write(listed.join(several, "key", "left"), "classed")
    scratch.drop(listed)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "line")
    shared = lines.where("component IS NOT NULL")
    first = shared.groupBy("component").agg(F.min(place).alias("first"))
    first = scratch.write(first, "kept")      # stored, so AQE can split a hot line in the join
    return lines, shared.join(first, "component").select(
        "doc_id", "text_key", "line", "component", (place == F.col("first")).alias("kept"),
        F.col("first.doc_id").alias("kept_doc"), F.col("first.line").alias("kept_line"))


def dropped_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, text_key, n_lines, dropped, kept_docs): per document with a line its lines to drop, numbered
    from 0, and the documents that keep them."""
    lines, grouped = _classed_lines(df, doc_id, text, **options)
    counts = lines.groupBy("doc_id", "text_key").agg(F.max("n_lines").cast("long").alias("n_lines"))
    drops = grouped.where("NOT kept").groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("of_text")).agg(
        F.array_sort(F.collect_set("line")).alias("dropped"), F.array_sort(F.collect_set("kept_doc")).alias("kept_docs"))
    rows = counts.join(drops, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("of_text")), "left")
    return rows.select("doc_id", "text_key", "n_lines", *[
        F.coalesce(c, F.array().cast(drops.schema[c].dataType)).alias(c) for c in ("dropped", "kept_docs")])


def with_dropped(df: DataFrame, drops: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[str]]:
    """Left join of rows and ``dropped_lines`` on id (null matches null) and text; names of the new columns."""
    rows, keys = with_row_key(df, doc_id, text)
    more = fresh(rows, "n_lines", "dropped", "kept_docs")
    found = row_key(drops, keys).withColumnsRenamed(dict(zip(("n_lines", "dropped", "kept_docs"), more)))
    return rows.join(found, keys, "left"), [*keys, *more]


def without_lines(text: Column, dropped: Column) -> Column:
    """``text`` without the lines of these numbers."""
    lines = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` without its duplicate lines; documents whose every line is kept elsewhere go.

    All columns stay, ``text`` shortened. Documents without any word to begin
    with are unchanged. Of rows that repeat both id and text, one keeps the
    document's lines and the others go.
    """
    rows, names = with_dropped(df, dropped_lines(df, doc_id, text, **options), doc_id, text)
    keys, (n, dropped, _) = names[:3], names[3:]
    copy, = fresh(rows, "copy")
    rows = rows.withColumn(copy, first_copy(keys))
    rows = rows.where(F.col(n).isNull() | ((F.size(dropped) < F.col(n)) & (F.col(copy) == 1)))
    short = F.when(F.size(dropped) > 0, without_lines(F.col(text), F.col(dropped))).otherwise(F.col(text))
    return rows.withColumn(text, short).select(*[F.col(f"`{c}`") for c in df.columns])
