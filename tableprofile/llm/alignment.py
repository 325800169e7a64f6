"""Alignment of two tokenizers over a corpus, as Arrow tables inside Spark tasks.

Both tokenizers encode the same bytes (a space and the text). Neither joins across a single
space between other characters, so a text is cut there into parts, and each different part
of a block of documents is encoded and aligned once. Token ends inside a part are segmented
running sums of token widths over the flattened id lists; the ends both tokenizers share,
found by an Acero hash join on (part, end), cut a part into groups. Ids of one group are
linked. Links of a part are a join of the counted ids of each group, so equal tokens are
never paired one by one, and a join is done in slices of about ``JOINED`` rows, whatever
the size of a group. A second hash join takes the links from parts to documents.

How many documents link a pair of ids is counted per block by ``Table.group_by`` and the
partial counts are added up by Spark. The counts go back to the blocks that asked for
them: what crosses the network is one row per block and different pair, not per link.

Texts that are null, empty, or that a tokenizer does not give back byte for byte have no
tokens: zeros, and '' as digest. Texts of any length go through whole; a text without a
single space is one part. Repeated rows and repeated ids are documents of their own; keys
may be null. An empty table gives no rows. Kept columns may have any names; they come back
under the same names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.llm.shared import by_size, kept_in_worker, unused

BLOCK_BYTES = 4 << 20
JOINED = 1 << 21
SPACE = "▁"

# A space where both tokenizers begin anew: single, between characters other than space.
_SEAM = re.compile(rf"(?<=[^\s{SPACE}]) (?=[^\s{SPACE}])")

FIGURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, " \
    "groups_sha256 string"


# Where a space stands beside white space, an end of the text, or what means a space.
_BLURRED = re.compile(rf" [\s{SPACE}]|[\s{SPACE}] |^ | $")


def parts_of(text: str | None) -> list[str]:
    """The parts between seams, which give the text when joined by spaces."""
    if not text:
        return []
    return _SEAM.split(text) if _BLURRED.search(text) else text.split(" ")


class ByteTokens:
    """A byte-level BPE of the ``tokenizers`` format; a space is put before each part.

    Where ids follow the order of merges, ranks say all there is to know, and ``tiktoken``
    encodes with the ranks of the file; otherwise the ``tokenizers`` library does.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        spelled = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items()
                   if all(c in letters for c in t)}
        size = max(model["vocab"].values()) + 1
        self.bytes = pa.array([spelled.get(i, b"") for i in range(size)], pa.large_binary())
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        turns = [model["vocab"][m.replace(" ", "")] for m in merged]
        special = {t for t in model["vocab"] if t.startswith("<|")}
        self.fast = None
        if turns == sorted(turns) and len(turns) + 256 == len(model["vocab"]) - len(special):
            ranks = {spelled[i]: i for t, i in model["vocab"].items() if t not in special}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
        else:
            self.slow = Tokenizer.from_file(path)
            self.slow.encode_special_tokens = True

    def encode(self, parts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.fast.encode_ordinary(" " + p) for p in parts]
        found = self.slow.encode_batch([" " + p for p in parts], add_special_tokens=False)
        return [x.ids for x in found]


# Fixed value: how the byte-level vocabulary splits a text into words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PieceTokens:
    """A sentencepiece model, which puts a space before each part by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            spelled.append(
                bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i)
                else piece.replace(SPACE, " ").encode())
        self.bytes = pa.array(spelled, pa.large_binary())

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self.model.encode(parts, num_threads=1)


def _tokenizer(path: str):
    """The tokenizer of a file, by its kind; loaded once in a worker."""
    kind = ByteTokens if path.endswith(".json") else PieceTokens
    return kept_in_worker(f"alignment:{path}", lambda: kind(path))


def _encoded(tokens, parts: list[str]) -> pa.LargeListArray:
    """The ids of each part, one list per part."""
    ids = tokens.encode(parts)
    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=offsets[-1])
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _joined_bytes(lists: pa.LargeListArray, spelled: pa.Array) -> pa.Array:
    """The bytes of the tokens of each part, one value per part."""
    taken = spelled.take(lists.flatten())
    widths = pc.binary_length(taken).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    offsets = pa.py_buffer(ends[lists.offsets.to_numpy()])
    data = taken.buffers()[2] or pa.py_buffer(b"")
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lists), [None, offsets, data])


@dataclass
class _Side:
    """The tokens of one tokenizer over some parts, flattened in order."""

    ids: pa.Array
    part: pa.Array
    end: pa.Array
    group: np.ndarray | None = None
    first: np.ndarray | None = None  # where each group begins


def _side(lists: pa.LargeListArray, spelled: pa.Array) -> _Side:
    ids, part = lists.flatten(), pc.list_parent_indices(lists).cast(pa.int32())
    width = pc.binary_length(spelled).cast(pa.int64()).take(ids)
    run = pc.cumulative_sum(width) if len(ids) else width
    # The running sum before a part is taken off its tokens.
    before = np.concatenate([[0], run.to_numpy()])[lists.offsets.to_numpy()[:-1]]
    return _Side(ids, part, pc.subtract(run, pa.array(before).take(part)))


def _cut(a: _Side, b: _Side) -> None:
    """Number the groups over all parts; they end where a token of both sides ends."""
    tables = [pa.table({"part": s.part, "end": s.end, "at": np.arange(len(s.ids))}) for s in (a, b)]
    for side, own, other in ((a, *tables), (b, *tables[::-1])):
        shared = own.join(
            other.select(["part", "end"]), ["part", "end"], join_type="left semi",
            use_threads=False)
        last = np.zeros(len(side.ids), dtype=np.int64)
        last[shared["at"].to_numpy()] = 1
        # A token is in the group after all that end before it.
        side.group = np.cumsum(last) - last
        side.first = np.concatenate([[0], np.flatnonzero(last) + 1])


@dataclass
class Parts:
    """The aligned tokens of some parts."""

    rows: int
    a: _Side
    b: _Side
    right: np.ndarray  # whether both tokenizers give the part back
    part_of_group: np.ndarray

    @property
    def n_groups(self) -> int:
        return len(self.part_of_group)

    def count(self, at: np.ndarray) -> np.ndarray:
        return np.bincount(at, minlength=self.rows)

    def lists(self, side: _Side, values: pa.Array) -> pa.LargeListArray:
        """Values of the tokens of a side, one list per group."""
        return pa.LargeListArray.from_arrays(pa.array(side.first), values)

    def group_texts(self) -> pa.Array:
        """Each group as ``a1,a2|b1``."""
        sides = [
            pc.binary_join(self.lists(s, s.ids.cast(pa.string())).cast(pa.list_(pa.string())), ",")
            for s in (self.a, self.b)
        ]
        return pc.binary_join_element_wise(*sides, "|")

    def links(self, pairs_b: int, joined: int = JOINED) -> pa.Table:
        """Links of each part and pair of ids, a pair being ``a * pairs_b + b``."""
        counted = []
        for name, side in (("a", self.a), ("b", self.b)):
            table = pa.table({"group": side.group, name: side.ids})
            table = table.group_by(["group", name], use_threads=False).aggregate(
                [([], "count_all")]).rename_columns(["group", name, f"n_{name}"])
            counted.append(table.sort_by("group"))
        left, right = counted
        at_left, at_right = (t["group"].to_numpy() for t in counted)
        partners = np.bincount(at_right, minlength=self.n_groups)[at_left] if self.n_groups else at_left
        slices = np.cumsum(partners) // joined
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(slices)) + 1, [len(slices)]])
        found = []
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if start == stop:
                continue
            low = np.searchsorted(at_right, at_left[start])
            high = np.searchsorted(at_right, at_left[stop - 1], side="right")
            both = left.slice(start, stop - start).join(
                right.slice(low, high - low), "group", join_type="inner", use_threads=False)
            pair = pc.add(
                pc.multiply(both["a"].cast(pa.int64()), pairs_b), both["b"].cast(pa.int64()))
            part = pa.array(self.part_of_group[both["group"].to_numpy()], pa.int32())
            times = pc.multiply(both["n_a"], both["n_b"])
            found.append(_summed(pa.table({"part": part, "pair": pair, "links": times})))
        if not found:
            return pa.table({
                "part": pa.array([], pa.int32()), "pair": pa.array([], pa.int64()),
                "links": pa.array([], pa.int64())})
        return found[0] if len(found) == 1 else _summed(pa.concat_tables(found))


def _summed(table: pa.Table) -> pa.Table:
    """Links of equal (place, pair) rows added up; the place is the first column."""
    keys = table.column_names[:2]
    return table.group_by(keys, use_threads=False).aggregate(
        [("links", "sum")]).rename_columns([*keys, "links"])


def align(parts: list[str], first, second) -> Parts:
    """Align the tokens of two tokenizers over some parts."""
    lists = [_encoded(t, parts) for t in (first, second)]
    space, plain = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    wanted = pc.binary_join_element_wise(space, pa.array(parts, pa.large_string()), plain)
    wanted = wanted.cast(pa.large_binary())
    right = np.ones(len(parts), dtype=bool)
    for own, tokens in zip(lists, (first, second)):
        right &= pc.equal(_joined_bytes(own, tokens.bytes), wanted).to_numpy(zero_copy_only=False)
    if not right.all():
        lists = [_without(own, pa.array(right)) for own in lists]
    a, b = (_side(own, tokens.bytes) for own, tokens in zip(lists, (first, second)))
    _cut(a, b)
    return Parts(len(parts), a, b, right, a.part.to_numpy()[a.first[:-1]])


def _without(lists: pa.LargeListArray, kept: pa.Array) -> pa.LargeListArray:
    """Empty lists where a part is not kept."""
    part = pc.list_parent_indices(lists)
    sizes = np.diff(lists.offsets.to_numpy()) * kept.to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeListArray.from_arrays(
        pa.array(offsets), lists.flatten().filter(kept.take(part)))


@dataclass
class Block:
    """Some documents as numbers of their parts, and the aligned parts."""

    rows: int
    at: np.ndarray  # the part at each place of the documents
    offsets: np.ndarray  # where the places of each document begin
    parts: Parts

    def doc_of_place(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows, dtype=np.int32), np.diff(self.offsets))

    def total(self, per_part: np.ndarray) -> np.ndarray:
        """Sums over the places of each document."""
        return np.diff(np.concatenate([[0], np.cumsum(per_part[self.at])])[self.offsets])

    def links(self, pairs_b: int) -> pa.Table:
        """Links of each document and pair of ids."""
        placed = pa.table({"doc": self.doc_of_place(), "part": self.at})
        placed = placed.group_by(["doc", "part"], use_threads=False).aggregate(
            [([], "count_all")]).rename_columns(["doc", "part", "times"])
        both = placed.join(
            self.parts.links(pairs_b), "part", join_type="inner", use_threads=False)
        return _summed(pa.table({
            "doc": both["doc"], "pair": both["pair"],
            "links": pc.multiply(both["times"], both["links"])}))


def aligned_block(texts: Sequence[str | None], first, second) -> Block:
    """The documents of a block; those a tokenizer does not give back have no parts."""
    lists = [parts_of(t) for t in texts]
    offsets = np.cumsum([0, *map(len, lists)], dtype=np.int64)
    coded = pa.array(list(chain.from_iterable(lists)), pa.large_string()).dictionary_encode()
    parts = align(coded.dictionary.to_pylist(), first, second)
    block = Block(len(texts), coded.indices.to_numpy(), offsets, parts)
    if not parts.right.all():
        wrong = block.total(~parts.right) > 0
        sizes = np.where(wrong, 0, np.diff(offsets))
        block.at = block.at[~np.repeat(wrong, np.diff(offsets))]
        block.offsets = np.concatenate([[0], np.cumsum(sizes)])
    return block


def _figures(block: Block, links: pa.Table) -> dict[str, pa.Array]:
    """What a document's own tokens tell, without the counts of the corpus."""
    parts = block.parts
    groups = parts.count(parts.part_of_group)
    texts = pc.binary_join(
        pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(groups)]), pa.int32()), parts.group_texts()),
        ";")
    whole = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(block.offsets, pa.int32()), texts.take(pa.array(block.at))),
        ";")
    digests = [
        hashlib.sha256(memoryview(text.as_buffer())).hexdigest() if n else ""
        for text, n in zip(whole, np.diff(block.offsets).tolist())
    ]
    times = np.zeros(block.rows, dtype=np.int64)
    np.add.at(times, links["doc"].to_numpy(), links["links"].to_numpy())
    return {
        "n_a": pa.array(block.total(parts.count(parts.a.part.to_numpy()))),
        "n_b": pa.array(block.total(parts.count(parts.b.part.to_numpy()))),
        "n_groups": pa.array(block.total(groups)),
        "n_links": pa.array(times),
        "groups_sha256": pa.array(digests),
    }


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


_BLOCKS = "block long, docs binary, links binary, pairs array<struct<a:int,b:int,docs:int>>"


@dataclass(frozen=True)
class Alignment:
    """Aligned documents, and the pairs of ids with the number of documents that link them."""

    documents: DataFrame
    pairs: DataFrame


def align_tokenizers(
    docs: DataFrame,
    first: str,
    second: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    block_bytes: int = BLOCK_BYTES,
) -> Alignment:
    """Align the tokenizers of two files over all documents.

    ``documents`` holds the kept columns and, per row, tokens of both sides, groups, links
    (pairs of occurrences in one group), links whose pair is linked by as many documents
    as any pair of its first id, the sum of those counts over all links, and the SHA-256
    of the groups as text. ``pairs`` holds ``a``, ``b``, ``documents`` and ``best``.
    """
    chosen = docs.select(*keep, text)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizer(first), _tokenizer(second)
        wide = len(b.bytes)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for own, texts in by_size(batch, block_bytes):
                block = aligned_block(texts, a, b)
                links = block.links(wide)
                kept = {f"k{i}": own.column(i) for i in range(len(keep))}
                figures = pa.table(kept | _figures(block, links))
                # Pairs of the block are numbered, and counted once per document.
                coded = pc.dictionary_encode(links["pair"].combine_chunks())
                pairs = coded.dictionary.to_numpy()
                numbers = coded.indices.to_numpy()
                held = np.bincount(numbers, minlength=len(pairs))
                small = pa.table({
                    "doc": links["doc"], "pair": pa.array(numbers, pa.int32()),
                    "links": links["links"]})
                counted = pa.StructArray.from_arrays(
                    [pa.array(pairs // wide, pa.int32()), pa.array(pairs % wide, pa.int32()),
                     pa.array(held, pa.int32())], ["a", "b", "docs"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + number]), pa.array([_packed(figures)], pa.binary()),
                     pa.array([_packed(small)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), counted)],
                    names=["block", "docs", "links", "pairs"])
                number += 1

    # Encoded once: what follows reads the packed blocks.
    held = cut_lineage(chosen.mapInArrow(blocks, _BLOCKS))
    asked = held.select("block", F.posexplode("pairs").alias("at", "pair")).select(
        "block", "at", "pair.*")
    counted = asked.groupBy("a", "b").agg(F.sum("docs").alias("documents"))
    highest = counted.groupBy("a").agg(F.max("documents").alias("highest"))
    pairs = cut_lineage(counted.join(highest, "a").select(
        "a", "b", "documents", (F.col("documents") == F.col("highest")).alias("best")))
    answers = asked.join(pairs, ["a", "b"]).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("at", "documents", "best"))).alias("answers"))
    rows = held.select("block", "docs", "links").join(answers, "block", "left").select(
        "docs", "links", "answers.documents", "answers.best")
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, *T._parse_datatype_string(FIGURES).fields])
    names = schema.names

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = _unpacked(batch.column(0)[i].as_py())
                links = _unpacked(batch.column(1)[i].as_py())
                yield from _counted(
                    own, links, batch.column(2)[i].values, batch.column(3)[i].values, names)

    return Alignment(rows.mapInArrow(finish, schema), pairs)


def _counted(own: pa.Table, links: pa.Table, documents, best, names) -> Iterator[pa.RecordBatch]:
    """The rows of a block with the counts of the corpus."""
    total = np.zeros(own.num_rows, dtype=np.int64)
    top = np.zeros(own.num_rows, dtype=np.int64)
    if links.num_rows:
        doc, times = links["doc"].to_numpy(), links["links"].to_numpy()
        np.add.at(total, doc, times * documents.to_numpy()[links["pair"].to_numpy()])
        is_best = best.to_numpy(zero_copy_only=False)[links["pair"].to_numpy()]
        np.add.at(top, doc, times * is_best)
    digest = own.column("groups_sha256")
    columns = [own.column(i) for i in range(own.num_columns - 1)]
    table = pa.table([*columns, pa.chunked_array([top]), pa.chunked_array([total]), digest], names=names)
    yield from table.to_batches(max_chunksize=1 << 14)


def aligned_groups(
    docs: DataFrame,
    first: str,
    second: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The groups themselves: kept columns, ``group`` from 0, and the ids ``a`` and ``b``."""
    chosen = docs.select(*keep, text)
    own = unused("group", keep)
    schema = T.StructType([
        *[docs.schema[c] for c in keep],
        *T._parse_datatype_string(f"{own} long, a array<int>, b array<int>").fields])
    names = schema.names

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizer(first), _tokenizer(second)
        for batch in batches:
            for rows, texts in by_size(batch, block_bytes):
                block = aligned_block(texts, a, b)
                parts = block.parts
                if not parts.n_groups:
                    continue
                # The groups of the part at each place, one after the other.
                size = parts.count(parts.part_of_group)
                sizes, first_group = size[block.at], (np.cumsum(size) - size)[block.at]
                shift = first_group - (np.cumsum(sizes) - sizes)
                chosen_groups = pa.array(np.repeat(shift, sizes) + np.arange(sizes.sum()))
                doc = np.repeat(block.doc_of_place(), sizes)
                number = np.arange(len(doc)) - np.searchsorted(doc, doc)
                lists = [
                    parts.lists(s, s.ids).cast(pa.list_(pa.int32())).take(chosen_groups)
                    for s in (parts.a, parts.b)]
                kept = [rows.column(i).take(pa.array(doc)) for i in range(len(keep))]
                table = pa.table([*kept, pa.array(number), *lists], names=names)
                yield from table.to_batches(max_chunksize=1 << 14)

    return chosen.mapInArrow(groups, schema)
