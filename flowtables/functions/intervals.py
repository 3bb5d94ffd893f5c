"""Markup inside a path, as slices of a row's token array.

The tokens of a batch of documents are one flat array.  Levels are a running sum of start and
end tags, minus its value where the document begins; the element that is open on a level is the
last start tag that reached it.  So what is inside a path is a mask over the tokens, without a
sort, and a run of text is a slice between two breaks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flowtables.functions.markup import VOID_ELEMENTS

#: at: place of the token; within: an element that is one token and ends the path; texts: the
#: tokens of a run of text, which has no token.
PIECES = "array<struct<at: int, token: string, within: boolean, texts: array<string>>>"
_PIECE = pa.struct([("at", pa.int32()), ("token", pa.string()), ("within", pa.bool_()), ("texts", pa.list_(pa.string()))])
#: Bytes of tokens that are looked at at a time, about.
BYTES = 4 << 20
_SPACE = r"[ \t\n\x0B\f\r]"


def slices(batches: Iterator[pa.RecordBatch], path: Sequence[str], html: bool, merge: bool, kinds: Sequence[str] | None = None) -> Iterator[pa.RecordBatch]:
    """For rows (id, tokens): the id and the pieces inside ``path``, runs of text as one if ``merge``, else
    those that may give an event of ``kinds``."""
    for batch in _parts(batches):
        tokens = batch.column(1).cast(pa.list_(pa.string()))
        starts = tokens.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        flat = tokens.flatten()
        kept, within = _inside(flat, starts, path, html)
        owner = np.repeat(np.arange(len(tokens)), np.diff(starts))[kept]
        at = (np.arange(len(flat)) - np.repeat(starts[:-1], np.diff(starts)))[kept].astype(np.int32)
        own = flat.take(pa.array(kept))
        if kinds is not None and not merge:
            some = np.flatnonzero(_may_give(own, kinds, html))
            own, at, kept, owner = own.take(pa.array(some)), at[some], kept[some], owner[some]
        pieces, owner = _pieces(own, at, within[kept], owner, merge)
        ends = np.searchsorted(owner, np.arange(len(tokens) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pieces)], names=[batch.schema.names[0], "pieces"])


#: at: place of the token; starts, ends: whether a document starts before it and ends after it.
MARKED = "array<struct<at: int, token: string, starts: boolean, ends: boolean>>"
_MARKED = pa.struct([("at", pa.int32()), ("token", pa.string()), ("starts", pa.bool_()), ("ends", pa.bool_())])


def marked(batches: Iterator[pa.RecordBatch], html: bool) -> Iterator[pa.RecordBatch]:
    """For rows (id, tokens): the id and all tokens, with where documents start and end.

    A document starts at the first element or processing instruction at the top since the last
    end, and ends with a top element."""
    for batch in _parts(batches):
        tokens = batch.column(1).cast(pa.list_(pa.string()))
        starts = tokens.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        flat = tokens.flatten()
        sizes = np.diff(starts)
        first = np.repeat(starts[:-1], sizes)
        end = _mask(pc.starts_with(flat, "</"))
        start = _mask(pc.starts_with(flat, "<")) & ~end & ~_mask(pc.match_substring_regex(flat, "^<([!?]|$)"))
        single = start & _mask(pc.ends_with(flat, "/>"))
        if html:
            name = pc.struct_field(pc.extract_regex(flat, r"^<(?P<name>[^ \t\n\x0B\f\r/>]+)"), "name")
            single |= start & _mask(pc.fill_null(pc.is_in(pc.utf8_lower(name), pa.array(VOID_ELEMENTS)), False))
            single |= start & _mask(pc.match_substring_regex(flat, r"(?is)^<(?:script|style)\b.*</"))
        step = (start & ~single).astype(np.int64) - end
        after = np.cumsum(step)
        after -= np.repeat(np.concatenate([[0], after])[starts[:-1]], sizes)
        top = after - step == 0  # nothing is open before the token
        instruction = _mask(pc.match_substring_regex(flat, r"(?s)^<\?.*\?>$")) & ~_mask(pc.match_substring_regex(flat, rf"^<\?[xX][mM][lL]{_SPACE}"))
        instruction &= pc.binary_length(flat).to_numpy(zero_copy_only=False) >= 4
        begins = (start | instruction) & top
        ends = (end & (after == 0)) | (single & top)
        marks = np.flatnonzero(begins | ends)
        last = np.concatenate([[-1], marks])[:-1] if len(marks) else marks
        goes_on = (last >= first[marks]) & ~ends[last]  # the mark before it has begun a document
        begins[marks[goes_on]] = False
        at = (np.arange(len(flat)) - first).astype(np.int32)
        pieces = pa.StructArray.from_arrays([pa.array(at), flat, pa.array(begins), pa.array(ends)], fields=[*_MARKED])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pieces)], names=[batch.schema.names[0], "pieces"]
        )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of about ``BYTES`` of tokens, so that what is held beside a batch does not grow with it."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, int(rows * BYTES / max(1, batch.column(1).nbytes)))
        for low in range(0, rows, step):
            yield batch.slice(low, step)


def _may_give(tokens: pa.Array, kinds: Sequence[str], html: bool) -> np.ndarray:
    """Tokens that give an event of ``kinds``, judged by how they begin and end, and maybe some that give none."""
    markup = _mask(pc.starts_with(tokens, "<")) & ~_mask(pc.equal(tokens, "<"))
    end, other = _mask(pc.starts_with(tokens, "</")), _mask(pc.starts_with(tokens, "<!")) | _mask(pc.starts_with(tokens, "<?"))
    start = markup & ~end & ~other
    out = np.zeros(len(tokens), bool)
    if "characters" in kinds:
        out |= ~markup | (start & html)
    if "start_element" in kinds:
        out |= start
    if "end_element" in kinds:
        out |= end | (start & (html | _mask(pc.ends_with(tokens, "/>"))))
    if not {"comment", "cdata", "processing_instruction", "error"}.isdisjoint(kinds):
        out |= other
    return out


def _mask(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(bool)


def _inside(flat: pa.Array, starts: np.ndarray, path: Sequence[str], html: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens inside elements of the path, and which tokens are such an element."""
    n, k = len(flat), len(path)
    none = np.zeros(n, bool)
    if not k or not n:
        return np.arange(n), none
    end = _mask(pc.starts_with(flat, "</"))
    start = _mask(pc.starts_with(flat, "<")) & ~end & ~_mask(pc.match_substring_regex(flat, "^<([!?]|$)")) & ~_mask(pc.ends_with(flat, "/>"))
    raw = _mask(pc.match_substring_regex(flat, r"(?is)^<(?:script|style)\b.*</")) if html else none
    tags = np.flatnonzero(start)
    named = pc.struct_field(pc.extract_regex(flat.take(pa.array(tags)), r"^<(?P<name>[^ \t\n\x0B\f\r/>]+)"), "name")
    named = pc.replace_substring_regex(named, "(?s)^.*:", "")
    if html:
        start[tags[_mask(pc.is_in(pc.utf8_lower(named), pa.array(VOID_ELEMENTS)))]] = False
        start &= ~raw
    after = np.cumsum(start.astype(np.int64) - end)
    base = np.repeat(np.concatenate([[0], after])[starts[:-1]], np.diff(starts))
    after -= base
    level = np.where(start, after - 1, after)  # of what a token is in
    first = np.repeat(starts[:-1], np.diff(starts))
    fits = np.ones(n, bool)
    parent = fits
    for i, name in enumerate(path):
        called = np.zeros(n, bool)
        called[tags] = _mask(pc.fill_null(pc.equal(named, name), False))
        opened = np.maximum.accumulate(np.where(start & (after == i + 1), np.arange(n), -1))
        parent = fits
        fits = fits & (opened >= first) & called[opened]
    inside = fits & (level >= k)
    within = raw & parent & (level == k - 1)
    if within.any():
        called = np.zeros(n, bool)
        called[tags] = _mask(pc.fill_null(pc.equal(named, path[-1]), False))
        within &= called
    return np.flatnonzero(inside | within), within


def _pieces(tokens: pa.Array, at: np.ndarray, within: np.ndarray, owner: np.ndarray, merge: bool) -> tuple[pa.Array, np.ndarray]:
    """Tokens, or runs of text, as structs, and the document of each."""
    n = len(tokens)
    if not merge:
        texts = pa.nulls(n, pa.list_(pa.string()))
        return pa.StructArray.from_arrays([pa.array(at), tokens, pa.array(within), texts], fields=[*_PIECE]), owner
    markup = _mask(pc.starts_with(tokens, "<"))
    plain = ~markup & _mask(pc.match_substring_regex(tokens, rf"[^{_SPACE[1:]}"))
    text = plain | _mask(pc.equal(tokens, "<")) | _mask(pc.match_substring_regex(tokens, r"(?s)^<!\[CDATA\[.*\]\]>$"))
    # White space, declarations and the like are no events and part no run.
    nothing = (~markup & ~plain) | _mask(pc.match_substring_regex(tokens, rf"(?s)^(<![^-\[].*>|<!>|<\?[xX][mM][lL]{_SPACE}.*\?>)$"))
    breaks = ~text & ~nothing
    fresh = np.concatenate([[True], owner[1:] != owner[:-1]]) if n else np.zeros(0, bool)
    run = np.cumsum(breaks | fresh)
    in_text = np.flatnonzero(text)
    begins = in_text[np.concatenate([[True], run[in_text][1:] != run[in_text][:-1]])] if len(in_text) else in_text
    lead = np.zeros(n, bool)
    lead[begins] = True
    out = np.flatnonzero(breaks | lead)
    runs = lead[out]
    sizes = np.zeros(len(out), np.int64)
    sizes[runs] = np.diff(np.concatenate([np.searchsorted(in_text, begins), [len(in_text)]]))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    texts = pa.ListArray.from_arrays(pa.array(ends), tokens.take(pa.array(in_text)), mask=pa.array(~runs))
    own = pc.if_else(pa.array(runs), pa.scalar(None, pa.string()), tokens.take(pa.array(out)))
    return pa.StructArray.from_arrays([pa.array(at[out]), own, pa.array(within[out]), texts], fields=[*_PIECE]), owner[out]
