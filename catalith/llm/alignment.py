"""Alignment of two tokenizers' tokens over the bytes of each text, by as-of merges."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import documents
from catalith.session import settle

ROW = pa.schema([
    ("chunk", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("steps", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
ROW_DDL = (
    "chunk bigint, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "steps binary, times binary, pairs array<bigint>, counts array<bigint>")
RESULT = pa.schema([(n, pa.int64()) for n in ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [
    ("groups_sha256", pa.string())])
RESULT_DDL = (
    "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string")
B_BITS = 24  # a pair is a * 2**24 + b
COMMA, BAR, SEMICOLON = 0, 1, 2


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the other bytes in turn for those from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """The bytes of every token, and their lengths."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.length = np.array([len(p) for p in pieces], np.int64)

    def spells(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids)) == raw


class ByteLevel(Vocabulary):
    """A byte-level tokenizer; a blank is put before the text."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        vocabulary, of = self.tokenizer.get_vocab(), byte_characters()
        pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            pieces[i] = bytes(map(of.__getitem__, token)) if all(c in of for c in token) else token.encode()
        super().__init__(pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found]


class Pieces(Vocabulary):
    """A sentence-piece tokenizer, which puts a blank before the text itself."""

    def __init__(self, name: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        pieces = []
        for i in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(i)
            byte = bytes([int(piece[1:-1], 16)]) if self.processor.is_byte(i) else None
            pieces.append(byte or piece.replace("▁", " ").encode())
        super().__init__(pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def vocabulary(name: str) -> ByteLevel | Pieces:
    """The worker's tokenizer for a file; only the file's name travels with a task."""
    return Pieces(name) if name.endswith(".model") else ByteLevel(name)


def _tokens(ids: list[np.ndarray], length: np.ndarray) -> pd.DataFrame:
    """id, document and first byte of each token; the documents' bytes stand one behind the other."""
    flat = np.concatenate(ids)
    size = length[flat]
    return pd.DataFrame({
        "at": np.cumsum(size) - size, "doc": np.repeat(np.arange(len(ids)), [len(i) for i in ids]), "id": flat,
        "place": np.arange(len(flat))}, copy=False)


def covering(tokens: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """For each token the place of the other side's token that covers its first byte, in the same document."""
    other = others[["at", "doc", "place"]].rename(columns={"place": "other"})
    return pd.merge_asof(tokens[["at", "doc"]], other, on="at", by="doc")["other"].to_numpy(np.int64)


@lru_cache(maxsize=2)
def _written(a_name: str, b_name: str) -> list[str]:
    """Ids of both sides as text before each separator, in one list."""
    sizes = (len(vocabulary(a_name).pieces), len(vocabulary(b_name).pieces))
    return [f"{i}{mark}" for size in sizes for mark in ",|;" for i in range(size)]


def align(a_ids: list[np.ndarray], b_ids: list[np.ndarray], a_name: str, b_name: str):
    """Links and groups of documents whose two token rows spell the same bytes.

    Each token's first byte finds the other side's token that covers it; the union of both directions
    is all overlaps, because of two overlapping tokens the later one begins inside the earlier.  Where
    both begin at one byte, both rows ended there, so a new group begins.

    Gives the document and id pair of each link, the number of groups of each document, and each document's
    groups as text.
    """
    a, b = vocabulary(a_name), vocabulary(b_name)
    left, right = _tokens(a_ids, a.length), _tokens(b_ids, b.length)
    to_b, to_a = covering(left, right), covering(right, left)
    a_at, b_at = left["at"].to_numpy(), right["at"].to_numpy()
    a_doc, b_doc = left["doc"].to_numpy(), right["doc"].to_numpy()
    a_id, b_id = left["id"].to_numpy(np.int64), right["id"].to_numpy(np.int64)
    a_first, b_first = b_at[to_b] == a_at, a_at[to_a] == b_at
    inner = np.flatnonzero(~b_first)
    docs = np.concatenate([a_doc, b_doc[inner]])
    pairs = np.concatenate([a_id << B_BITS | b_id[to_b], a_id[to_a[inner]] << B_BITS | b_id[inner]])
    groups = np.bincount(a_doc[a_first], minlength=len(a_ids))

    # a group is written as its a tokens, then its b tokens: each token's place in that order, and what follows it
    a_group, b_group = np.cumsum(a_first) - 1, np.cumsum(b_first) - 1
    a_size, b_size = (np.bincount(g, minlength=int(a_first.sum())) for g in (a_group, b_group))
    a_until, b_until = np.cumsum(a_size), np.cumsum(b_size)
    a_place, b_place = np.arange(len(a_id)), np.arange(len(b_id))
    order = np.empty(len(a_id) + len(b_id), np.int64)
    mark = np.where(a_place + 1 == a_until[a_group], BAR, COMMA)
    order[a_place + (b_until - b_size)[a_group]] = mark * len(a.pieces) + a_id
    mark = np.where(b_place + 1 == b_until[b_group], SEMICOLON, COMMA)
    order[b_place + a_until[b_group]] = 3 * len(a.pieces) + mark * len(b.pieces) + b_id
    words = _written(a_name, b_name)
    ends = np.cumsum([len(x) + len(y) for x, y in zip(a_ids, b_ids)]).tolist()
    texts = ["".join(map(words.__getitem__, order[x:y].tolist()))[:-1] for x, y in zip([0, *ends], ends)]
    return docs, pairs, groups, texts


# A blank behind another character and before a visible one.  Both tokenizers begin a token there: the byte-level one
# gives the last blank of a run to the word behind it, and no piece holds a blank behind another character.
EDGE = re.compile(r"(?<=[^ ]) (?=\S)")


class Segments:
    """Alignments of the segments between edges; the tokens, groups and links of a text are those of its segments.

    New segments are aligned in batches and remembered, up to ``keep`` of them, as words repeat; beyond that the
    memory starts anew, which changes nothing but time.  A segment is (pairs as bytes, groups as text, n_a,
    n_b, n_groups), or None where a side does not spell it.
    """

    def __init__(self, a_name: str, b_name: str, keep: int, batch: int = 1 << 17):
        self.names, self.keep, self.batch, self.known = (a_name, b_name), keep, batch, {}

    def _encoded(self, segments: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """The segments that both sides spell, with their ids: all as one text, parted at the segments' ends."""
        sides = [vocabulary(n) for n in self.names]
        plain = [s for s in segments if s and not s[0].isspace() and s[-1] != " "]
        joined = " ".join(plain)
        raw, ends = b" " + joined.encode(), np.cumsum([len(s.encode()) + 1 for s in plain])
        parts = []
        for side in sides if plain else ():
            ids = side.encode([joined])[0]
            whole = side.spells(ids, raw)
            ids = np.array(ids, np.int32)
            until = np.cumsum(side.length[ids])
            cuts = np.searchsorted(until, ends) + 1
            if not whole or not np.array_equal(until[cuts - 1], ends):
                break
            parts.append([ids[x:y] for x, y in zip([0, *cuts.tolist()], cuts.tolist())])
        if len(parts) == 2:
            yield from zip(plain, *parts)
        done = set(plain) if len(parts) == 2 else set()
        rest = [s for s in segments if s not in done]
        for segment, *ids in zip(rest, *[side.encode(rest) for side in sides]) if rest else ():
            if all(side.spells(i, b" " + segment.encode()) for side, i in zip(sides, ids)):
                yield segment, *[np.array(i, np.int32) for i in ids]

    def _learn(self, segments: list[str]) -> None:
        self.known.update(dict.fromkeys(segments))
        same = list(self._encoded(segments))
        if not same:
            return
        whose, a_ids, b_ids = zip(*same)
        owner, pairs, groups, written = align(a_ids, b_ids, *self.names)
        order = np.argsort(owner, kind="stable")
        ends = (8 * np.cumsum(np.bincount(owner, minlength=len(whose)))).tolist()
        raw, counts = pairs[order].astype("<i8").tobytes(), groups.tolist()
        for k, start in enumerate([0, *ends[:-1]]):
            self.known[whose[k]] = (raw[start: ends[k]], written[k], len(a_ids[k]), len(b_ids[k]), counts[k])

    def of(self, texts: list[str]) -> list[list]:
        """The segments of each text."""
        parts = [EDGE.split(t) for t in texts]
        needed = set().union(*parts)
        fresh = needed.difference(self.known)
        if len(self.known) + len(fresh) > self.keep:
            self.known, fresh = {}, needed
        run, size = [], 0
        for segment in fresh:
            run.append(segment)
            size += len(segment) + 8
            if size >= self.batch:
                self._learn(run)
                run, size = [], 0
        if run:
            self._learn(run)
        return [list(map(self.known.__getitem__, p)) for p in parts]


@lru_cache(maxsize=1)
def segments(a_name: str, b_name: str, keep: int) -> Segments:
    """The worker's memory."""
    return Segments(a_name, b_name, keep)


def _batches(texts: list[str | None], most: int) -> Iterator[list[int]]:
    """Places of the texts that are there, in runs of about ``most`` characters."""
    run, size = [], 0
    for i, text in enumerate(texts):
        if text:
            run.append(i)
            size += len(text)
            if size >= most:
                yield run
                run, size = [], 0
    if run:
        yield run


def _aligner(a_name: str, b_name: str, chunk_bytes: int, keep: int, batch_bytes: int = 1 << 19):
    def chunk_rows(chunk: int, ids: list, texts: list[str | None]) -> list[dict]:
        memory = segments(a_name, b_name, keep)
        rows = [dict(chunk=chunk, id=i, n_a=0, n_b=0, n_groups=0, n_links=0, groups_sha256="") for i in ids]
        docs, pairs = [], []
        for run in _batches(texts, batch_bytes):
            for place, found in zip(run, memory.of([texts[i] for i in run])):
                if None in found:
                    continue
                raw, written, n_a, n_b, n_groups = zip(*found)
                pair = np.frombuffer(b"".join(raw), "<i8")
                rows[place] |= dict(
                    n_a=sum(n_a), n_b=sum(n_b), n_groups=sum(n_groups), n_links=len(pair),
                    groups_sha256=hashlib.sha256(";".join(written).encode()).hexdigest())
                docs.append(np.full(len(pair), place))
                pairs.append(pair)
        if not docs:
            return rows
        codes, distinct = pd.factorize(np.concatenate(pairs))
        counts = np.bincount(codes)
        # each document's pairs once, in order of their place in the chunk's list, with their times
        key = np.sort(np.concatenate(docs) * len(distinct) + codes)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.diff(np.append(first, len(key))).astype("<u4")
        owner, code = np.divmod(key[first], len(distinct))
        starts = np.searchsorted(owner, np.arange(len(rows) + 1))
        steps = np.diff(code, prepend=0)
        begins = starts[:-1][starts[:-1] < starts[1:]]
        steps[begins] = code[begins]
        steps = steps.astype("<u4")
        for place in np.unique(owner):
            own = slice(starts[place], starts[place + 1])
            rows[place] |= dict(steps=steps[own].tobytes(), times=times[own].tobytes())
        rows.append(dict(chunk=chunk, pairs=distinct, counts=counts))
        return rows

    def slices(batches: Iterator[pa.RecordBatch]):
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(text)
                size += len(text or "") + 100
                if size >= chunk_bytes:
                    yield ids, texts
                    ids, texts, size = [], [], 0
        if ids:
            yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, (ids, texts) in enumerate(slices(batches)):
            rows = chunk_rows(first + k, ids, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.get(f.name) for r in rows], f.type) for f in ROW], schema=ROW)

    return run


def _summed(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums of each document of one chunk, from the corpus-wide counts of the chunk's pairs."""
    n = docs.num_rows
    order = np.argsort(pairs.column("place").to_numpy())
    total, best = pairs.column("total").to_numpy()[order], pairs.column("best").to_numpy()[order]
    raw = [x or b"" for x in docs.column("steps").to_pylist()]
    sizes = np.array([len(x) // 4 for x in raw])
    owner = np.repeat(np.arange(n), sizes)
    running = np.cumsum(np.frombuffer(b"".join(raw), "<u4").astype(np.int64))
    before = np.concatenate([[0], running])[np.cumsum(sizes) - sizes]
    code = running - before[owner]
    times = np.frombuffer(b"".join(x or b"" for x in docs.column("times").to_pylist()), "<u4").astype(np.int64)
    edge = np.cumsum(np.concatenate([[0], sizes]))
    summed = []
    for amount in (times * best[code], times * total[code]):
        up_to = np.concatenate([[0], np.cumsum(amount)])
        summed.append(pa.array(up_to[edge[1:]] - up_to[edge[:-1]], pa.int64()))
    return pa.table([
        *[docs.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")], *summed, docs.column("groups_sha256")],
        schema=RESULT)


def aligned(
    docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id",
    text_col: str = "text", chunk_bytes: int = 4 << 20, remember: int = 300_000,
) -> tuple[DataFrame, DataFrame]:
    """The aligned documents and the corpus-wide id pairs (a_id, b_id, links, best).

    Whole texts are aligned segment by segment (``Segments``), new ones in batches; chunks hold about ``chunk_bytes`` (a longer text is a
    chunk of its own).  A chunk counts its links per id pair before anything is shuffled and keeps each document's pairs as
    positions in the chunk's list of pairs.  So a pair that every text holds is one row per chunk, links
    are never rows, and what goes back to a chunk is one count for each of its pairs.  ``best`` marks the
    pairs whose links are the most of their b id, ties included; those maxima are at most one row per b id.

    The documents have id_col, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.  Missing and
    empty texts, and texts that one of the token rows does not spell byte by byte behind a blank, have no tokens:
    zeros and an empty digest.  Repeated rows each get a row and each count, ids are not looked at, a
    missing id stays missing, other columns are not read, an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chunks = settle(rows.mapInArrow(_aligner(a, b, chunk_bytes, remember), ROW_DDL), "aligned-chunks")
    listed = chunks.where("pairs IS NOT NULL")
    totals = settle(
        listed.select(F.explode(F.arrays_zip("pairs", "counts")).alias("of"))
        .groupBy(F.col("of.pairs").alias("pair")).agg(F.sum("of.counts").alias("total")), "pair-totals")
    b_id = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    most = totals.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("most"))
    known = settle(
        totals.withColumn("b_id", b_id).join(F.broadcast(most), "b_id")
        .select("pair", "total", (F.col("total") == F.col("most")).cast("bigint").alias("best")), "pair-counts")
    counted = listed.select(F.col("chunk").alias("home"), F.posexplode("pairs").alias("place", "pair")).join(
        known, "pair").select("home", "place", "total", "best")
    own = chunks.where("pairs IS NULL").select(
        "chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "steps", "times")
    found = own.groupBy("chunk").cogroup(counted.groupBy("home")).applyInArrow(_summed, RESULT_DDL)
    pairs = known.select(
        F.shiftright("pair", B_BITS).alias("a_id"), b_id.alias("b_id"), F.col("total").alias("links"),
        (F.col("best") == 1).alias("best"))
    return found.withColumnRenamed("id", id_col), pairs


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of every document between the byte-level and the sentence-piece vocabulary."""
    return aligned(documents(spark, sf_dir, "doc_id", "text"))[0]
