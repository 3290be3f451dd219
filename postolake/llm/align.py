"""Cross-tokenizer alignment: where two tokenizers cut a text at the same bytes.

Each text is encoded by a byte-level BPE (A, given a leading space) and by a
piece model with byte fallback (B, which adds that space itself). Byte offsets
at which tokens of both end cut a text into groups; the tokens that end there
together are linked. Over the whole corpus every (A id, B id) pair is counted
by how many links hold it, and each text is told how many of its links are the
commonest partner of their B id.

The work inside a task is Arrow tables: lists of ids are flattened with their
parent indices, cumulative sums of token byte lengths restart at each text,
both sides meet in an Acero hash join on (text, end), and ``Table.group_by``
counts the pairs of a block. Spark merges these partial counts by pair. A block
(about ``BLOCK_BYTES`` of text, or one longer text) then gets the totals of just
its own distinct pairs, so neither links nor the table of pairs are ever
gathered, and a pair that a third of all links hold is one row a block.

Defined cases:

* a text that is null or empty, or that either tokenizer does not give back
  byte for byte (joined token bytes differ from space + text), has no tokens:
  zeros and an empty digest;
* strings of special tokens inside a text are plain text;
* repeated rows and repeated or null ids stay as they are, one result row per
  input row, and each counts;
* ties for the commonest partner all count as best;
* an empty table gives an empty result; other columns, whatever their names,
  are not read;
* a very long text is a block of its own.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .scratch import written

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20
ENCODE_BYTES = 1 << 17

_LOW = (1 << 32) - 1


def byte_alphabet() -> dict[str, int]:
    """The printable character of each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the code
    points from 256 on, in byte order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def _table(entries: dict[int, bytes]) -> pa.Array:
    size = max(entries, default=-1) + 1
    return pa.array([entries.get(k, b"") for k in range(size)], pa.large_binary())


class ByteBpe:
    """Token ids of space + text, and the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._encode = Tokenizer.from_file(path)
        self._encode.encode_special_tokens = True
        back = byte_alphabet()
        vocab = self._encode.get_vocab(with_added_tokens=True)
        self.bytes = _table(
            {
                i: bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
                for token, i in vocab.items()
            }
        )

    def __call__(self, texts: list[str]) -> pa.Array:
        found = self._encode.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return pa.array([e.ids for e in found], pa.list_(pa.int32()))


class Pieces:
    """Piece ids of a text (the model adds the leading space), and the bytes of each id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        entries, pieces = {}, []
        for i in range(self._model.get_piece_size()):
            pieces.append(self._model.id_to_piece(i))
            piece = self._model.id_to_piece(i)
            entries[i] = bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()
        self.bytes = _table(entries)
        # no piece goes on after a space that follows something else, so texts part there
        self.apart = all("▁" not in p.lstrip("▁") for p in pieces)

    def __call__(self, texts: list[str]) -> pa.Array:
        return pa.array(self._model.encode(texts, num_threads=1), pa.list_(pa.int32()))


@lru_cache(maxsize=2)
def tokenizers(folder: str) -> tuple[ByteBpe, Pieces]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return ByteBpe(os.path.join(folder, BYTE_BPE)), Pieces(os.path.join(folder, PIECES))


def _encoded(encode, texts: pa.Array) -> pa.Array:
    """Ids of each text, encoded a few at a time (encoders hold far more than ids)."""
    parts = [
        encode(chunk.column("text").to_pylist())
        for chunk in tv.text_chunks([pa.RecordBatch.from_arrays([texts], names=["text"])], "text", ENCODE_BYTES)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _cut_points(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Starts of the parts of texts (each begins with a space) that can be encoded on their own.

    Besides the start of a text these are lone spaces between two characters
    that are no white space in any sense: ASCII marks, letters and digits, and
    the two-byte Latin letters from U+00C0 to U+017F. Byte-level pre-tokens and
    pieces begin there or hold no such space (``Pieces.apart`` tells).
    """
    plain, wide = (data > 0x20) & (data < 0x7F), (data >= 0xC3) & (data <= 0xC5)
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        before = plain[:-2].copy()
        before[1:] |= (data[1:-2] >= 0x80) & wide[:-3]
        cut[1:-2] = (data[1:-1] == 0x20) & before & (plain | wide)[2:]
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


def _shared(wanted: pa.Array, encoders: list) -> list[pa.Array]:
    """Ids of each text by each encoder; a part that occurs again in the block is encoded once."""
    _, offsets, data = wanted.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[wanted.offset : wanted.offset + len(wanted) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    starts = _cut_points(offsets, raw)
    ends = np.append(starts[1:], len(raw)).astype(np.int64)
    _, first, number = np.unique(tv.span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    if not len(starts):
        return [pa.array([], pa.list_(pa.int32())) for _ in encoders]
    # every other span between these edges is a part without its leading space
    edges = np.stack([starts + 1, ends], axis=1).reshape(-1).astype(np.int64)
    spans = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)])
    distinct = spans.take(pa.array(2 * first)).cast(pa.large_string())
    of_text = np.searchsorted(starts, offsets)
    out = []
    for encode in encoders:
        ids = _encoded(encode, distinct).take(pa.array(number))
        upto = (ids.offsets.to_numpy() - ids.offsets[0].as_py())[of_text]
        out.append(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), ids.flatten()))
    return out


def _tokens(ids: pa.Array, vocabulary: pa.Array, wanted: pa.Array) -> tuple[pa.Table, np.ndarray]:
    """Table (doc, end, id) of all tokens in order, and whether each text's joined bytes are ``wanted``."""
    flat, doc = ids.flatten(), pc.list_parent_indices(ids)
    spelled = pc.take(vocabulary, flat)
    upto = pc.cumulative_sum(pc.binary_length(spelled).cast(pa.int64()))
    upto = np.concatenate([[0], upto.to_numpy(zero_copy_only=False)])
    borders = upto[ids.offsets.to_numpy() - ids.offsets[0].as_py()]
    _, _, data = spelled.buffers()
    joined = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(borders), data or pa.py_buffer(b"")])
    same = pc.equal(joined, wanted).to_numpy(zero_copy_only=False).astype(bool)
    end = upto[1:] - borders[doc.to_numpy()]  # the sum restarts at each text
    table = pa.table({"doc": doc.cast(pa.int64()), "end": pa.array(end), "id": flat})
    return table, same


def _joined_ids(table: pa.Table, closes: np.ndarray) -> pa.Array:
    """Comma-joined ids of each group; ``closes`` marks the last token of a group."""
    offsets = np.concatenate([[0], np.flatnonzero(closes) + 1]).astype(np.int32)
    names = table.column("id").cast(pa.string()).combine_chunks()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names), ",")


def _closes(table: pa.Table, cuts: np.ndarray) -> np.ndarray:
    """Whether a token is the last one at a cut (``cuts``: sorted doc << 40 | end)."""
    key = _place(table)
    at = np.searchsorted(cuts, key)
    hit = (at < len(cuts)) & (cuts[np.minimum(at, max(len(cuts) - 1, 0))] == key) if len(cuts) else np.zeros(len(key), bool)
    last = np.ones(len(key), dtype=bool)
    last[:-1] = key[1:] != key[:-1]
    return hit & last


def _place(table: pa.Table) -> np.ndarray:
    return (table.column("doc").to_numpy() << 40) | table.column("end").to_numpy()


class Aligned:
    """Alignment of one block of texts: per-text counts and group strings, and the block's pairs."""

    def __init__(self, texts: pa.Array, a: ByteBpe, b: Pieces):
        n = len(texts)
        live = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
        chosen = texts.take(pa.array(live))
        wanted = pc.binary_join_element_wise(
            pa.scalar("", pa.large_string()), chosen.cast(pa.large_string()), pa.scalar(" ", pa.large_string())
        ).cast(pa.large_binary())
        if b.apart:
            ids_a, ids_b = _shared(wanted, [a, b])
        else:
            ids_a, ids_b = _encoded(a, chosen), _encoded(b, chosen)
        left, same_a = _tokens(ids_a, a.bytes, wanted)
        right, same_b = _tokens(ids_b, b.bytes, wanted)
        sound = pa.array(same_a & same_b)
        left = left.filter(pc.take(sound, left.column("doc")))
        right = right.filter(pc.take(sound, right.column("doc")))

        met = left.rename_columns(["doc", "end", "a"]).join(
            right.rename_columns(["doc", "end", "b"]), keys=["doc", "end"], join_type="inner", use_threads=False
        )
        met = met.take(pa.array(np.argsort(_place(met), kind="stable")))  # the join keeps no order
        ends = _place(met)
        cuts = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
        groups = pc.binary_join_element_wise(
            _joined_ids(left, _closes(left, cuts)), _joined_ids(right, _closes(right, cuts)), "|"
        )
        group_doc, link_doc = live[cuts >> 40], live[met.column("doc").to_numpy()]
        at = np.concatenate([[0], np.cumsum(np.bincount(group_doc, minlength=n))]).astype(np.int32)
        self.groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(at), groups), ";")
        self.n_a = np.bincount(live[left.column("doc").to_numpy()], minlength=n)
        self.n_b = np.bincount(live[right.column("doc").to_numpy()], minlength=n)
        self.n_groups = np.diff(at).astype(np.int64)

        pair = pc.add(pc.shift_left(met.column("a").cast(pa.int64()), 32), met.column("b").cast(pa.int64()))
        counted = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by("pair")
        self.pairs = counted.column("pair").combine_chunks()
        self.counts = counted.column("pair_count").combine_chunks().cast(pa.int64())
        place = pc.index_in(pair.combine_chunks(), value_set=self.pairs)
        link_at = np.concatenate([[0], np.cumsum(np.bincount(link_doc, minlength=n))]).astype(np.int32)
        self.links = pa.ListArray.from_arrays(pa.array(link_at), place)


def _digest(groups: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(g.as_py().encode()).hexdigest() if len(g.as_py()) else "" for g in groups], pa.string())


def _align_blocks(batches, folder: str, with_groups: bool, block_bytes: int) -> Iterator[pa.RecordBatch]:
    a, b = tokenizers(folder)
    block = TaskContext.get().partitionId() << 32
    for batch in tv.text_chunks(batches, "text", block_bytes):
        done = Aligned(batch.column("text"), a, b)
        n = batch.num_rows
        rows = {
            "doc_id": batch.column("doc_id"),
            "block": pa.array(np.full(n, block)),
            "n_a": pa.array(done.n_a),
            "n_b": pa.array(done.n_b),
            "n_groups": pa.array(done.n_groups),
            "groups_sha256": _digest(done.groups),
            "groups": done.groups if with_groups else pa.nulls(n, pa.string()),
            "links": done.links,
            "pairs": pa.nulls(n, pa.list_(pa.int64())),
            "counts": pa.nulls(n, pa.list_(pa.int64())),
        }
        docs = pa.RecordBatch.from_pydict(rows)
        yield docs
        if len(done.pairs):
            whole = pa.array([0, len(done.pairs)], pa.int32())
            own = {name: pa.nulls(1, docs.schema.field(name).type) for name in docs.schema.names} | {
                "block": pa.array([block]),
                "pairs": pa.ListArray.from_arrays(whole, done.pairs),
                "counts": pa.ListArray.from_arrays(whole, done.counts),
            }
            yield pa.RecordBatch.from_pydict(own, schema=docs.schema)
        block += 1


def _totals_of_block(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Per-text sums of the totals of its links' pairs."""
    links = docs.column("links").combine_chunks()
    doc, place = pc.list_parent_indices(links).to_numpy(), links.flatten().to_numpy()
    size = int(place.max()) + 1 if len(place) else 0
    count, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    at = answers.column("place").to_numpy()
    count[at] = answers.column("count").to_numpy()
    best[at] = answers.column("best").to_numpy()
    n_links = np.bincount(doc, minlength=docs.num_rows).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(n_links)])
    sums = tv.segment_sums(count[place], upto)
    n_best = tv.segment_sums(best[place], upto)
    out = docs.drop_columns(["links", "block"])
    for name, values in (("n_links", n_links), ("n_best", n_best), ("count_sum", sums)):
        out = out.append_column(name, pa.array(values))
    return out


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str = TOKENIZERS,
    with_groups: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, groups_sha256, groups, n_links, n_best, count_sum.

    ``groups`` is the alignment itself, ``a1,a2|b1;a3|b2,b3`` (decimal ids of A
    and B in order), given if ``with_groups``; its SHA-256 is always given.
    ``folder`` holds the two vocabulary files on every worker.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, block long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, "
        "links array<int>, pairs array<long>, counts array<long>"
    )
    found = written(rows.mapInArrow(lambda b: _align_blocks(b, folder, with_groups, block_bytes), schema), "align")

    partial = found.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "counts")))
    partial = partial.select("block", F.col("pos").alias("place"), F.col("col.pairs").alias("pair"), F.col("col.counts").alias("n"))
    totals = partial.groupBy("pair").agg(F.sum("n").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(_LOW)))  # at most as many rows as A has ids
    totals = totals.withColumn("best", (F.col("count") == F.max("count").over(of_b)).cast("long"))
    answers = partial.join(totals, "pair").select(F.col("block").alias("of"), "place", "count", "best")
    texts = found.where("pairs is null").drop("pairs", "counts")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, n_links long, n_best long, count_sum long"
    return texts.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_totals_of_block, out)
