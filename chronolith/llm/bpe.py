"""BPE encoding and decoding over a table of distinct words.

Words are split off as the byte-level tokenizer itself splits them. Texts are taken in chunks; a text becomes the
positions of its words in its chunk's list of distinct words, and the chunks' lists meet, dealt by the words' hashes, in
one table in which each distinct word of the corpus is encoded once. The ids go back to the chunks and are joined to the
texts by position; decoding looks each id up in the table of pieces, which has as many rows as the vocabulary.

What moves is packed: a chunk's words by range of hash, its ids in the same order, and positions instead of texts.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chronolith.llm import cells, common

#: The byte-level tokenizer's own splitting; white space as Unicode's property has it.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Beyond these characters two libraries may differ in Unicode's version: such texts are split by the tokenizer.
SURE = regex.compile(r"[\x00-ɏ‐-‧‰-⁞€]*")
#: A chunk ends with the text that brings it to so many characters or distinct words.
CHUNK_CHARS, CHUNK_WORDS = 24_000_000, 400_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def tokenizer(path: str | None):
    """The tokenizer of the file at path (null: the default), without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path or default_path())
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def pieces(path: str | None) -> tuple[bytes, ...]:
    """The bytes of each id, in order: the id-to-piece table."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocabulary = tokenizer.__wrapped__(path).get_vocab(with_added_tokens=True)  # who only decodes keeps no tokenizer
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(of[c] for c in token)
    return tuple(out)


@lru_cache(maxsize=2)
def specials(path: str | None):
    """A pattern of the special tokens, longest first, or None; and their ids."""
    added = {t.content: i for i, t in tokenizer(path).get_added_tokens_decoder().items()}
    found = sorted(added, key=len, reverse=True)
    return (regex.compile("(" + "|".join(map(regex.escape, found)) + ")") if found else None), added


def words(text: str, path: str | None = None) -> list[str]:
    """The text's words in order; a special token is a word of its own. Their concatenation is the text."""
    special, known = specials(path)
    if special is not None and special.search(text):
        return list(itertools.chain.from_iterable([p] if p in known else words(p, path) for p in special.split(text) if p))
    if SURE.fullmatch(text):
        return WORD.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer(path).pre_tokenizer.pre_tokenize_str(text)]


def encode_words(found: list[str], path: str | None = None) -> list[tuple[int, ...]]:
    return [tuple(e.ids) for e in tokenizer(path).encode_batch(found, add_special_tokens=False)]


def decode_ids(ids: list[int], path: str | None = None) -> str:
    return b"".join(map(pieces(path).__getitem__, ids)).decode("utf-8", "replace")


def _shut(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=7).compress(b)


def _open(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b)


def _planes(a: np.ndarray) -> bytes:
    """Numbers byte by byte, so that like bytes stand together."""
    return np.ascontiguousarray(a.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def packed_words(found: list[bytes]) -> bytes:
    sizes = [len(found), *map(len, found)]
    return _shut(np.array([len(found)], "<u4").tobytes() + _planes(np.array(sizes)) + b"".join(found))


def unpacked_words(b: bytes) -> list[bytes]:
    raw = _open(b)
    start = 4 + 4 * (int.from_bytes(raw[:4], "little") + 1)
    ends = np.cumsum(np.concatenate([[start], _numbers(raw[4:start])[1:]])).tolist()
    return [raw[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]


def packed_ids(found: list[tuple[int, ...]]) -> bytes:
    many = np.array([len(x) for x in found], np.int64)
    ids = np.fromiter(itertools.chain.from_iterable(found), np.int64)
    return _shut(np.array([len(found)], "<u4").tobytes() + _planes(many) + _planes(ids))


def unpacked_ids(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each word has, and the ids."""
    raw = _open(b)
    end = 4 + 4 * int.from_bytes(raw[:4], "little")
    return _numbers(raw[4:end]), _numbers(raw[end:])


def ranked(texts: list[np.ndarray], words: int) -> tuple[np.ndarray, int]:
    """New numbers for the words that texts hold places of: words that occur more than once come first, the most frequent
    ahead, then those that occur once, in their order. And how many occur more than once."""
    many = np.bincount(np.concatenate([np.zeros(0, np.int64), *texts]), minlength=words)
    order = np.argsort(np.where(many > 1, -many, 0), kind="stable")
    number = np.empty(words, np.int32)
    number[order] = np.arange(words, dtype=np.int32)
    return number, int((many > 1).sum())


def packed_places(texts: list[np.ndarray], known: int, often: int) -> bytes:
    """Places of the words of some texts, as ranked() numbers them: a word that occurs once is 0, as it follows the known
    ones and those before it here, others their place + 1. Those of frequent words are a byte each; the rest is marked
    there and follows."""
    place = np.concatenate([np.zeros(0, np.int32), *texts])
    code = np.where(place >= often, 0, place + 1)
    sizes = np.array([known, len(texts), *map(len, texts)], "<u4")
    return _shut(sizes.tobytes() + np.minimum(code, 255).astype(np.uint8).tobytes() + _planes(code[code >= 255]))


def unpacked_places(b: bytes) -> list[np.ndarray]:
    raw = _open(b)
    known, many = np.frombuffer(raw, "<u4", 2).tolist()
    ends = np.cumsum(np.frombuffer(raw, "<u4", many, 8).astype(np.int64))
    start, total = 8 + 4 * many, int(ends[-1]) if many else 0
    code = np.frombuffer(raw, np.uint8, total, start).astype(np.int64)
    code[code == 255] = _numbers(raw[start + total :])
    return np.split(np.where(code == 0, known + np.cumsum(code == 0), code) - 1, ends[:-1])


#: Rows of the split corpus: of each chunk the part of each of its words (part -1), its words, a row for each range of
#: hashes (part from 0), and its texts (part null), of which the first of so many holds the places of their words.
SPLIT = "chunk string, part int, at long, packed binary"
TOGETHER = 256


def split(documents: DataFrame, path: str | None, parts: int, cut: Callable[[str], list[str]] | None = None, pack: Callable[[list[bytes], np.ndarray], bytes] | None = None) -> DataFrame:
    """documents but for text as chunks: SPLIT, then their columns. cut splits a text (as the tokenizer does, if it isn't
    given), pack takes a range's words and how often each stands in the chunk."""
    kept = documents.drop("text")
    names, schema = kept.columns, StructType([*StructType.fromDDL(SPLIT).fields, *(StructField(f.name, f.dataType) for f in kept.schema.fields)])  # null where a row is no text
    cut, pack = cut or (lambda t: words(t, path)), pack or (lambda found, _: packed_words(found))

    def made(index: dict[str, int], texts: list[np.ndarray], rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, often = ranked(texts, len(index))
        many = np.empty(len(index), np.int64)
        many[number] = np.bincount(np.concatenate([np.zeros(0, np.int64), *texts]), minlength=len(index))
        found = list(index)
        index.clear()
        raw = [found[i].encode("utf-8", "surrogatepass") for i in np.argsort(number)]
        found.clear()
        part = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % parts
        chunk = f"{TaskContext.get().partitionId()}-{len(ended)}"
        ended.append(chunk)
        yield batch_of([chunk], [-1], [0], [_shut(_planes(part))], None)
        order = np.argsort(part, kind="stable")
        starts = cells.bounds(part[order]) if len(order) else []
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            yield batch_of([chunk], [int(part[order[s]])], [0], [pack([raw[i] for i in order[s:e]], many[order[s:e]])], None)
        columns = pa.Table.from_batches(rows).combine_chunks() if names else None
        known = often
        for k in range(0, len(texts), TOGETHER):
            some = [number[p] for p in texts[k : k + TOGETHER]]
            packed = [packed_places(some, known, often), *[None] * (len(some) - 1)]
            known += sum(int((p >= often).sum()) for p in some)
            yield batch_of([chunk] * len(some), [None] * len(some), range(k, k + len(some)), packed, columns.slice(k, TOGETHER) if names else None)

    def batch_of(chunk, part, at, packed, columns) -> pa.RecordBatch:
        found = [pa.array(chunk, pa.string()), pa.array(part, pa.int32()), pa.array(at, pa.int64()), pa.array(packed, pa.binary())]
        found += [pa.nulls(len(chunk), t) for t in types[0]] if columns is None else [c.combine_chunks() for c in columns.columns]
        return pa.RecordBatch.from_arrays(found, names=schema.names)

    types: list = [[]]
    ended: list[str] = []  # chunks of this task

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, texts, rows, size = {}, [], [], 0
        ended.clear()
        for batch in batches:
            other = batch.select(names) if names else batch
            types[0], first = [f.type for f in other.schema] if names else [], 0
            for k, t in enumerate(common.texts_of(batch)):
                texts.append(np.fromiter((index.setdefault(w, len(index)) for w in cut(t)), np.int32))
                size += len(t)
                if size >= CHUNK_CHARS or len(index) >= CHUNK_WORDS:
                    yield from made(index, texts, [*rows, other.slice(first, k + 1 - first)])
                    index, texts, rows, size, first = {}, [], [], 0, k + 1
            if first < batch.num_rows:
                rows.append(other.slice(first))
        if texts:
            yield from made(index, texts, rows)

    return common.arrow_batches(documents.select("text", *names), schema, each)


def encoded_words(table: DataFrame, path: str | None, parts: int) -> DataFrame:
    """chunk, part and packed ids for rows of words (chunk, part, packed): each distinct word is encoded once. A task holds
    the distinct words of one range, however many chunks have them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, now = {}, None
        for batch in batches:
            packed = []
            for part, b in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if part != now:
                    of.clear()
                    now = part
                found = unpacked_words(b)
                new = [w for w in found if w not in of]
                of.update(zip(new, encode_words([w.decode("utf-8", "surrogatepass") for w in new], path), strict=True))
                packed.append(packed_ids([of[w] for w in found]))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("part"), pa.array(packed, pa.binary())], names=["chunk", "part", "packed"])

    dealt = table.repartition(parts, "part").sortWithinPartitions("part")
    return common.arrow_batches(dealt, "chunk string, part int, packed binary", each)


def encode(documents: DataFrame, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """documents without text, with n_tokens (long), ids (array of int, left out without keep_ids), id_list (the ids in
    decimal, joined by commas) and decoded (the ids turned back into text).

    As the tokenizer with add_special_tokens=False: special tokens that occur in a text become their ids. Null and empty
    texts have no ids; very long ones are a chunk of their own. Repeated rows each give a row, an empty table none.
    Columns of these names are replaced; others pass through, whatever their names.
    """
    spark = documents.sparkSession
    added = StructType.fromDDL("n_tokens long, " + "ids array<int>, " * keep_ids + "id_list string, decoded string")
    through = [c for c in documents.columns if c.lower() not in {"text", "n_tokens", "ids", "id_list", "decoded"}]
    # Other columns travel as one, so that none of them can have a name that is used here.
    kept = documents.select(F.struct(*([F.col(f"`{c}`") for c in through] or [F.lit(0)])).alias("row"), "text")
    parts = common.partitions(spark)
    corpus = common.written(split(kept, path, parts), "bpe-split")
    ids = encoded_words(corpus.where("part >= 0").select("chunk", "part", "packed"), path, parts)
    names = ["row"]
    both = corpus.where("part IS NULL OR part < 0").unionByName(ids, allowMissingColumns=True)
    both = both.repartition(parts, "chunk").sortWithinPartitions("chunk", F.col("part").asc_nulls_last(), "at")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, written = pieces(path), [f"{i}," for i in range(len(pieces(path)))]
        piece_size, written_size = (np.array([len(x) for x in y], np.int64) for y in (piece, written))
        now, of_words, held, places, many, flat, starts = None, None, [], [], None, None, None
        raw, raw_at, raw_end, text, text_at, text_end = b"", None, None, "", None, None

        def each_word(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Where each word of the chunk starts and ends in what its ids make when they are strung together."""
            at = np.concatenate([[0], np.cumsum(size[flat])])
            return at[starts], at[starts + many]

        def strung(parts: list, empty):
            """What the ids make, in the order of flat; some at a time, as a list of numbers is large."""
            return empty.join(empty.join([parts[i] for i in flat[k : k + 50_000].tolist()]) for k in range(0, len(flat), 50_000))

        def made(batch: pa.RecordBatch, rows: list[tuple], keep: list[int]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            some = batch.select(names).take(pa.array(keep)).columns
            rows.clear(), keep.clear()
            return pa.RecordBatch.from_arrays([*some, *columns], names=[*names, *added.names])

        for batch in batches:
            rows, keep, room = [], [], common.BATCH_BYTES
            for k, (chunk, part, packed) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("chunk", "part", "packed")), strict=True)):
                if chunk != now:
                    now, held, many = chunk, [], None
                if part is not None:
                    if part < 0:
                        of_words = _numbers(_open(packed))
                    else:
                        held.append(unpacked_ids(packed))
                    continue
                if many is None:  # the chunk's words are complete: what each stands for is written and looked up once
                    some, flat = (np.concatenate([np.zeros(0, np.int64), *(h[i] for h in held)]) for i in (0, 1))
                    order = np.argsort(of_words, kind="stable")  # the words by part, as they were sent
                    many, starts = np.empty_like(some), np.empty_like(some)
                    many[order], starts[order] = some, np.cumsum(some) - some
                    raw, (raw_at, raw_end) = strung(piece, b""), each_word(piece_size)
                    text, (text_at, text_end) = strung(written, ""), each_word(written_size)
                    held = []
                if packed is not None:
                    places = unpacked_places(packed)[::-1]
                at = places.pop()
                size = many[at]
                row = [int(size.sum())]
                if keep_ids:
                    row.append(flat[np.repeat(starts[at] - (np.cumsum(size) - size), size) + np.arange(row[0])])
                cut = lambda whole, s, e, empty: empty.join([whole[i:j] for i, j in zip(s[at].tolist(), e[at].tolist(), strict=True)])  # noqa: B023, E731
                rows.append((*row, cut(text, text_at, text_end, "")[:-1], cut(raw, raw_at, raw_end, b"").decode("utf-8", "replace")))
                keep.append(k)
                room -= len(rows[-1][-1]) + len(rows[-1][-2]) + 8 * row[0]
                if room < 0:
                    yield made(batch, rows, keep)
                    room = common.BATCH_BYTES
            if rows:
                yield made(batch, rows, keep)

    types = [pa.int64(), *([pa.list_(pa.int32())] if keep_ids else []), pa.string(), pa.string()]
    out = common.arrow_batches(both, StructType([StructField("row", kept.schema["row"].dataType), *added.fields]), each)
    return out.select(*[F.col("row").getField(c).alias(c) for c in through], *added.names)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded (with ids) with decoded: the pieces of the ids, looked up by id and read as UTF-8. Null ids give ''. A column
    of that name is replaced, others pass through."""
    return common.with_columns(encoded.drop("decoded"), "decoded string", lambda batch, _: [pa.array([decode_ids(ids or [], path) for ids in batch.column("ids").to_pylist()], pa.string())])


def digests(encoded: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return encoded.select("doc_id", "n_tokens", sha("id_list").alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))
