"""Removal of repeated passages: every byte of a 100-byte string that also starts earlier.

1. Each 100-byte window has an anchor that its content alone decides: its 24-byte string with the
   least hash. Windows that follow one another with one anchor form a segment (under 180 bytes,
   however long the text), and equal windows have equal anchors.
2. Blocks of texts deal (anchor, hash of the segment, place) by anchor. A segment that occurred
   before is a repeat as a whole; an anchor with a single segment has no other repeats.
3. Where segments with one anchor differ, their bytes meet: the Burrows-Wheeler transform and common
   prefixes of this collection are built column by column (``suffixes``), and suffixes that share
   100 bytes are one string, of which only the first is kept. Equal windows have their anchor at
   the same place, so columns are counted from it and a round sorts one suffix per segment.
   Rounds are as many as a segment is long, not as a text is.
4. An anchor with more than ``Sizes.crowd`` different segments (the border of a passage that very many
   texts hold) sends its windows as hashes instead, which meet one by one.

A block sends a segment or window once, with its first place there, so what fills a third of
all texts costs a row per block. Texts travel with their block and leave as soon as nothing is
open for them; the transform is held in memory, as its collection is small.

Earlier is: smaller id, or same id and smaller start; a null id is the largest. Rows with one id
and start do not remove each other, so two equal rows with one id are both kept. Null and
empty texts have no bytes; shorter ones than 100 bytes are kept. Other columns are carried
along whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.llm.blocks import Hashes, ragged, text_blocks
from vocabweave.llm.suffixes import equal_windows

LENGTH = 100
GRAM = 24
NULL_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Sizes:
    """How work is cut up; the results are the same for all values."""

    block_bytes: int = 4 << 20
    piece_bytes: int = 1 << 20
    part_segments: int = 400_000
    collection_bytes: int = 2 << 20
    #: Different segments of an anchor that are still compared by their bytes.
    crowd: int = 2000


SIZES = Sizes()


PACKED = "part int, block string, kind string, payload binary"
_PACKED = pa.schema([("part", pa.int32()), ("block", pa.string()), ("kind", pa.string()), ("payload", pa.binary())])
_COMPRESSED = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))


def _press(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=_COMPRESSED) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpress(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def _columns(**arrays: np.ndarray) -> bytes:
    return _press(pa.table({k: pa.array(v) for k, v in arrays.items()}))


def _arrays(payload: bytes) -> dict[str, np.ndarray]:
    table = _unpress(payload)
    return {name: column.to_numpy() for name, column in zip(table.column_names, table.columns, strict=True)}


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, _PACKED.types, strict=True)], schema=_PACKED)


def segments(data: np.ndarray, offsets: np.ndarray, piece_bytes: int = SIZES.piece_bytes) -> tuple[np.ndarray, ...]:
    """(start, number of windows, hash of the anchor, hash of the bytes, place of the anchor) of all segments of a block."""
    parts = [_piece(data, offsets, at, piece_bytes) for at in range(0, max(len(data) - LENGTH + 1, 0), piece_bytes)]
    return tuple(map(np.concatenate, zip(*parts, strict=True))) if parts else tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.uint64, np.uint64, np.int64))


def _piece(data, offsets, at, piece_bytes):
    """The segments whose windows start in one piece of the block."""
    data = data[at : at + piece_bytes + LENGTH - 1]
    hashes = Hashes(data)
    grams = len(data) - GRAM + 1
    value = hashes.grams(GRAM)
    # least hash of each run of grams, the leftmost of equals: least of the end of one stretch and the start of the next
    low = np.uint64((1 << 24) - 1)
    key = (value & ~low) | np.arange(grams, dtype=np.uint64)
    run = LENGTH - GRAM + 1
    stretch = np.full(-(-grams // run) * run, ~np.uint64(0))
    stretch[:grams] = key
    stretch = stretch.reshape(-1, run)
    heads = np.minimum.accumulate(stretch, axis=1).ravel()
    tails = np.minimum.accumulate(stretch[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tails[: grams - run + 1], heads[run - 1 : grams])
    anchor = (least & low).astype(np.int64)

    begin = np.clip(offsets[:-1] - at, 0, len(data))
    finish = np.clip(offsets[1:] - at, 0, len(data))
    window = ragged(begin, np.maximum(finish - begin - LENGTH + 1, 0))
    place = anchor[window]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(window) != 1) | (np.diff(place) != 0)])) if len(window) else window
    count = np.diff(np.append(first, len(window)))
    start = window[first]
    return start + at, count, value[place[first]], hashes.of(start, start + count + LENGTH - 1), place[first] - start


def _first(order: np.ndarray, keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in ``order`` (by keys, doc, start): the group of each and whether it is at the group's first place."""
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= np.diff(key[order]) != 0
    group = np.cumsum(fresh) - 1
    head = order[np.flatnonzero(fresh)][group] if len(order) else order
    return group, (doc[order] == doc[head]) & (start[order] == start[head])


def _dealer(parts: int, id_column: str, text_column: str, sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for i, j, data, offsets in text_blocks(batch.column(text_column), sizes.block_bytes):
                yield from emit(pa.Table.from_batches([batch.slice(i, j - i)]), data, offsets, number).to_batches()
                number += 1

    def emit(rows: pa.Table, data: np.ndarray, offsets: np.ndarray, number: int) -> pa.Table:
        ids = rows.column(id_column).cast(pa.int64()).fill_null(NULL_ID).to_numpy()
        start, count, anchor, content, shift = segments(data, offsets, sizes.piece_bytes)
        row = np.searchsorted(offsets, start, "right") - 1
        doc, start = ids[row], start - offsets[row]
        order = np.lexsort((start, doc, content, anchor))
        _, first = _first(order, [anchor, content], doc, start)
        again = order[~first]
        order = np.sort(order[first])
        part = ((anchor[order] >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)
        order = order[np.argsort(part, kind="stable")]
        cuts = np.searchsorted(np.sort(part), np.arange(parts + 1))
        digest = xxhash.xxh3_64_intdigest(data.tobytes() + ids.tobytes())
        # equal blocks of a task differ by their number
        block = f"{TaskContext.get().partitionId()}-{number}-{digest:x}"
        out = [
            (digest % parts, block, "rows", _press(rows)),
            (digest % parts, block, "again", _columns(row=row[again].astype(np.uint32), start=start[again], size=(count[again] + LENGTH - 1).astype(np.uint32))),
        ]
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            own = order[cuts[p] : cuts[p + 1]]
            out.append((p, block, "segments", _columns(
                row=np.diff(row[own], prepend=0).astype(np.int32), doc=np.diff(doc[own], prepend=0), start=start[own].astype(np.uint32),
                count=count[own].astype(np.uint16), low=anchor[own].astype(np.uint32), content=content[own], shift=shift[own].astype(np.uint8),
            )))
        return _rows(out)

    return run


def _meeter(crowd: int):
    """Compares the segments of a part: repeats, those to be compared by their bytes, and crowds."""

    def run(table: pa.Table) -> pa.Table:
        kept, asked = [], []
        for part, block, kind, payload in zip(*(c.to_pylist() for c in table.columns), strict=True):
            if kind == "segments":
                asked.append((part, block, _arrays(payload)))
            else:
                kept.append((part, block, kind, payload))
        if not asked:
            return _rows(kept)
        joined = {name: np.concatenate([a[name] if name not in ("row", "doc") else np.cumsum(a[name], dtype=np.int64) for _, _, a in asked]) for name in asked[0][2]}
        anchor, content, doc, start = (joined[n] for n in ("low", "content", "doc", "start"))
        order = np.lexsort((start, doc, content, anchor))
        group, first = _first(order, [anchor, content], doc, start)
        kinds = order[np.flatnonzero(np.diff(group, prepend=-1))]  # one row per different segment
        names, at, different = np.unique(anchor[kinds], return_inverse=True, return_counts=True)
        others = different[at][group]
        state = np.zeros(len(order), np.uint8)
        state[order] = np.where(~first, 1, np.where(others == 1, 0, np.where(others <= crowd, 2, 3)))
        lengths = np.cumsum([0, *(len(a["low"]) for _, _, a in asked)])
        for (part, block, _), a, b in zip(asked, lengths[:-1], lengths[1:], strict=True):
            open_ = a + np.flatnonzero(state[a:b])
            kept.append((part, block, "segments", _columns(
                row=joined["row"][open_].astype(np.uint32), start=start[open_], count=joined["count"][open_], low=anchor[open_], state=state[open_], shift=joined["shift"][open_],
            )))
        return _rows(kept)

    return run


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(depth) > 0).astype(np.int8)]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _finished(rows: pa.Table, text_column: str, spans: dict[str, np.ndarray], finish) -> pa.Table:
    """``rows`` with the spans (row, start, size) cut out."""
    order = np.argsort(spans["row"], kind="stable")
    cuts = np.searchsorted(spans["row"][order], np.arange(rows.num_rows + 1))
    kept, figures = [], []
    for i, text in enumerate(rows.column(text_column).to_pylist()):
        text = (text or "").encode()
        own = order[cuts[i] : cuts[i + 1]]
        a, b = _covered(len(text), spans["start"][own], spans["start"][own] + spans["size"][own])
        cut = [text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)] if len(own) else [text]
        kept.append(b"".join(cut))
        figures.append((len(text), int((b - a).sum()), len(a)))
    return finish(rows, kept, figures)


def _spans(payloads: list[bytes]) -> dict[str, np.ndarray]:
    parts = [_arrays(p) for p in payloads]
    return {n: np.concatenate([np.zeros(0, np.int64), *(p[n].astype(np.int64) for p in parts)]) for n in ("row", "start", "size")}


def _opener(parts: int, id_column: str, text_column: str, finish):
    """Per block: finishes the texts with nothing open; sends the bytes or windows of the others' open segments."""

    def run(table: pa.Table) -> pa.Table:
        part, block, kind, payload = (c.to_pylist() for c in table.columns)
        rows = [p for k, p in zip(kind, payload, strict=True) if k == "rows"]
        if not rows:
            raise ValueError("the rows of the texts changed between two runs of a task")
        rows, spans = _unpress(rows[0]), [p for k, p in zip(kind, payload, strict=True) if k == "again"][:1]
        ids = rows.column(id_column).cast(pa.int64()).fill_null(NULL_ID).to_numpy()
        open_ = [(p, _arrays(x)) for p, k, x in zip(part, kind, payload, strict=True) if k == "segments"]
        a = {n: np.concatenate([np.zeros(0, np.int64), *(x[n].astype(np.int64) for _, x in open_)]) for n in ("row", "start", "count", "low", "state", "shift")}
        own_part = np.concatenate([np.zeros(0, np.int64), *(np.full(len(x["row"]), p) for p, x in open_)])
        again = a["state"] == 1
        spans.append(_columns(row=a["row"][again], start=a["start"][again], size=a["count"][again] + LENGTH - 1))
        waiting = np.zeros(rows.num_rows, bool)
        waiting[a["row"][a["state"] > 1]] = True
        spans = _spans(spans)
        number = np.cumsum(waiting) - 1
        done, later = np.flatnonzero(~waiting), np.flatnonzero(waiting)
        # the part that the block's digest names, so that blocks are spread evenly
        out, home = [], int(block[0].rsplit("-", 1)[1], 16) % parts
        for chosen, name in ((done, "done"), (later, "rows")):
            if not len(chosen):
                continue
            at = np.full(rows.num_rows, -1, np.int64)
            at[chosen] = np.arange(len(chosen))
            own = at[spans["row"]] >= 0
            few = {"row": at[spans["row"]][own], "start": spans["start"][own], "size": spans["size"][own]}
            if name == "done":
                out.append((home, block[0], "done", _press(_finished(rows.take(pa.array(chosen)), text_column, few, finish))))
            else:
                out += [(home, block[0], "rows", _press(rows.take(pa.array(chosen)))), (home, block[0], "spans", _columns(**few))]
        if len(later):
            texts = [(t or "").encode() for t in rows.column(text_column).take(pa.array(later)).to_pylist()]
            data = np.frombuffer(b"".join(texts), np.uint8)
            base = np.cumsum([0, *map(len, texts)])
            for p in np.unique(own_part[a["state"] == 2]).tolist():
                i = np.flatnonzero((own_part == p) & (a["state"] == 2))
                i = i[np.argsort(a["low"][i], kind="stable")]
                size = a["count"][i] + LENGTH - 1
                piece = data[ragged(base[number[a["row"][i]]] + a["start"][i], size)]
                strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(i), [None, pa.py_buffer(np.cumsum([0, *size]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(piece))])
                out.append((p, block[0], "bytes", _press(pa.table({
                    "row": pa.array(number[a["row"][i]].astype(np.uint32)), "doc": pa.array(ids[a["row"][i]]), "start": pa.array(a["start"][i]),
                    "low": pa.array(a["low"][i].astype(np.uint32)), "shift": pa.array(a["shift"][i].astype(np.uint8)), "bytes": strings,
                }))))
            i = np.flatnonzero(a["state"] == 3)
            if len(i):
                window_row = np.repeat(number[a["row"][i]], a["count"][i])
                window = ragged(a["start"][i], a["count"][i])
                where = base[window_row] + window
                content = Hashes(data).of(where, where + LENGTH)
                doc = ids[later][window_row]
                order = np.lexsort((window, doc, content))
                _, first = _first(order, [content], doc, window)
                repeat = order[~first]
                out.append((home, block[0], "spans", _columns(row=window_row[repeat], start=window[repeat], size=np.full(len(repeat), LENGTH))))
                order = np.sort(order[first])
                to = ((content[order] >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
                for p in np.unique(to).tolist():
                    own = order[to == p]
                    out.append((p, block[0], "windows", _columns(row=window_row[own].astype(np.uint32), doc=doc[own], start=window[own], content=content[own])))
        return _rows(out)

    return run


def _resolver(collection_bytes: int):
    """Finds the windows of a part that start earlier elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        kept, strings, windows = [], [], []
        for part, block, kind, payload in zip(*(c.to_pylist() for c in table.columns), strict=True):
            (strings if kind == "bytes" else windows if kind == "windows" else kept).append((part, block, kind, payload))
        if windows:
            own = [_arrays(p) for *_, p in windows]
            doc, start, content = (np.concatenate([o[n] for o in own]) for n in ("doc", "start", "content"))
            order = np.lexsort((start, doc, content))
            _, first = _first(order, [content], doc, start)
            repeat = np.zeros(len(order), bool)
            repeat[order[~first]] = True
            kept += _answers(windows, own, repeat, np.full(len(repeat), LENGTH))
        if strings:
            tables = [_unpress(p) for *_, p in strings]
            own = [{n: t.column(n).to_numpy() for n in ("row", "start", "doc", "low", "shift")} for t in tables]
            parts = [t.column("bytes").chunk(0) for t in tables]
            doc, start, low, shift = (np.concatenate([o[n] for o in own]).astype(np.int64) for n in ("doc", "start", "low", "shift"))
            sizes = np.concatenate([np.diff(np.frombuffer(p.buffers()[1], np.int64)[p.offset : p.offset + len(p) + 1]) for p in parts])
            data = np.concatenate([np.frombuffer(p.buffers()[2], np.uint8)[: int(np.frombuffer(p.buffers()[1], np.int64)[len(p)])] for p in parts])
            begin = np.cumsum(sizes) - sizes
            order = np.argsort(low, kind="stable")
            # whole groups of one anchor, together until they fill a collection
            group_start = np.flatnonzero(np.diff(low[order], prepend=-1))
            total = np.cumsum(sizes[order])[np.append(group_start[1:], len(order)) - 1]
            cut, filled = [0], 0
            for k, size in enumerate(total.tolist()):
                if size - filled >= collection_bytes:
                    cut.append(int(np.append(group_start[1:], len(order))[k]))
                    filled = size
            found_string, found_offset = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in zip(cut, [*cut[1:], len(order)], strict=True):
                some = order[a:b]
                if len(some):
                    string, offset = _repeated(data, begin[some], sizes[some], shift[some], doc[some], start[some])
                    found_string.append(some[string])
                    found_offset.append(offset)
            string, offset = np.concatenate(found_string), np.concatenate(found_offset)
            number = np.cumsum([0, *(len(o["row"]) for o in own)])
            by = np.searchsorted(number, string, "right") - 1
            row = np.concatenate([o["row"] for o in own]).astype(np.int64)
            for k in np.unique(by).tolist():
                mine = by == k
                kept.append((strings[k][0], strings[k][1], "spans", _columns(row=row[string[mine]], start=start[string[mine]] + offset[mine], size=np.full(int(mine.sum()), LENGTH))))
        return _rows(kept)

    return run


def _answers(rows, own, repeat, size):
    out, at = [], 0
    for (part, block, _, _), o in zip(rows, own, strict=True):
        mine = np.flatnonzero(repeat[at : at + len(o["row"])])
        out.append((part, block, "spans", _columns(row=o["row"][mine].astype(np.int64), start=o["start"][mine].astype(np.int64), size=size[at + mine])))
        at += len(o["row"])
    return out


def _repeated(data, begin, sizes, shift, doc, start) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of the windows of a collection that start earlier in it."""
    string, offset, group = equal_windows(data, begin, sizes, shift, LENGTH)
    where = start[string] + offset
    order = np.lexsort((where, doc[string], group))
    _, first = _first(order, [group], doc[string], where)
    again = order[~first]
    return string[again], offset[again]


def _closer(text_column: str, finish):
    def run(table: pa.Table) -> pa.Table:
        _, _, kind, payload = (c.to_pylist() for c in table.columns)
        named = lambda name: [p for k, p in zip(kind, payload, strict=True) if k == name]
        done = [_unpress(p) for p in named("done")[:1]]
        for rows in named("rows")[:1]:
            done.append(_finished(_unpress(rows), text_column, _spans(named("spans")), finish))
        return pa.concat_tables(done)

    return run


def _digests(id_column: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def finish(rows, kept, figures):
        columns = [rows.column(id_column).cast(pa.int64()), *([f[i] for f in figures] for i in range(3)), [hashlib.sha256(k).hexdigest() for k in kept]]
        return pa.table(columns, schema=schema)

    return finish


def _texts(text_column: str):
    def finish(rows, kept, figures):
        texts = pa.array([None if t is None else k.decode(errors="ignore") for t, k in zip(rows.column(text_column).to_pylist(), kept, strict=True)], pa.string())
        return rows.set_column(rows.column_names.index(text_column), text_column, texts)

    return finish


def _run(documents: DataFrame, doc_id: str, text: str, finish, schema, sizes: Sizes) -> DataFrame:
    length = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # a segment begins about every (LENGTH - GRAM + 2) / 2 bytes
    parts = max(1, math.ceil(length / ((LENGTH - GRAM + 2) / 2) / sizes.part_segments))
    dealt = documents.mapInArrow(_dealer(parts, doc_id, text, sizes), PACKED).repartition(parts, "part")
    met = dealt.groupBy("part").applyInArrow(_meeter(sizes.crowd), PACKED)
    opened = met.groupBy("block").applyInArrow(_opener(parts, doc_id, text, finish), PACKED).repartition(parts, "part")
    resolved = opened.groupBy("part").applyInArrow(_resolver(sizes.collection_bytes), PACKED)
    return resolved.groupBy("block").applyInArrow(_closer(text, finish), schema)


def without_repeats(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sizes: Sizes = SIZES) -> DataFrame:
    """``documents`` with the repeated bytes cut out of ``text``; what is left of a character that a cut splits goes too."""
    return _run(documents, doc_id, text, _texts(text), documents.schema, sizes)


def digest(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sizes: Sizes = SIZES) -> DataFrame:
    """Per row: id, bytes, removed bytes, maximal removed runs, and a digest of the bytes that are left."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return _run(rows, "doc_id", "text", _digests("doc_id"), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", sizes)
