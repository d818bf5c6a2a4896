"""Token ids in flat binary files.

``write`` encodes documents and writes, for each range of doc_id, ``tokens-NNNNNN.bin`` (the ids of its documents in
ascending doc_id, flat little-endian unsigned integers of 16 bits if the vocabulary allows, else 32),
``docs-NNNNNN.bin`` (their doc_ids, int64) and ``offsets-NNNNNN.bin`` (uint64: the global start of each document, and the
end of the last).  A range's base is the sum of the tokens of all ranges before it.  The table ``parts`` (Parquet, a row a
range) has the bases, ``manifest.json`` the kind of integer and the totals.  ``read`` maps the files into memory.

Documents are encoded before they are dealt out, so what is shuffled is ids and not texts.  The task of a range gets them
sorted and writes them as they come, whatever the range's size.  Files are written under another name and renamed, so a
task that runs again leaves the same files.

Ids come from the ``tokenizers`` library.  Where a tokenizer takes each stretch between white space by itself (which
``by_words`` checks), each stretch is encoded by the library once and remembered (a bounded number of
them); texts of any other tokenizer are encoded whole.

Defined results: a null text is an empty one and has the end id only; a null doc_id comes first (and is stored as the
least int64); rows that share a doc_id are in the order of a hash of their texts, and may fill several ranges; other
columns are ignored; no rows, no files but the manifest and an empty table.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, compress
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilescan.llm.common import cut, shared_dir, ship, texts
from tilescan.llm.op4_bpe import Memory
from tilescan.llm.ranges import LEAST, keyed, ranges_of

MEMORY = 300_000
MARKS = ".,;:!?%$#|"
# fixed values: white space to Python's split and not to the tokenizers library; splitters of the library at white space
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACE = re.compile("[\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SPLITTERS = frozenset(["Whitespace", "WhitespaceSplit", "BertPreTokenizer"])
KEEPERS = frozenset(["NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"])
PROBES = ("a", "Z9", "é", "'s", "don't", "7", ".", "(x)", "!?", "ß,", "中", "\u0301b", "_", "--", "🙂")


def _steps(part: dict | None, inner: str) -> list[dict]:
    """The steps of a sequence within sequences."""
    if not part:
        return []
    return [x for p in part.get(inner) or [] for x in _steps(p, inner)] if part.get("type") == "Sequence" else [part]


def by_words(definition: dict, tokenizer) -> bool:
    """Whether a tokenizer takes each stretch between white space by itself.  Its definition must normalise character by
    character or to single blanks, split at white space or keep only what its pattern matches, and have no added token that
    reaches over white space; and pairs of probes on either side of white space must have the ids of both."""
    blank = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if not all(x.get("type") in KEEPERS or x == blank for x in _steps(definition.get("normalizer"), "normalizers")):
        return False
    first = (_steps(definition.get("pre_tokenizer"), "pretokenizers") or [{}])[0]
    if first.get("type") not in SPLITTERS and not (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")):
        return False
    if definition.get("truncation") or definition.get("padding"):
        return False
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or SPACE.search(t.get("content", "")) for t in definition.get("added_tokens") or []):
        return False
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    alone = {x: ids(x) for x in PROBES}
    return all(ids(x + w + y) == alone[x] + alone[y] for x in PROBES for y in PROBES for w in (" ", "\n", " \t\r\n", "\xa0"))


def missing(memory: Memory, keys: set[str]) -> set[str]:
    """What of ``keys`` has no value yet; the others are among the latest afterwards."""
    out = keys.difference(memory.now)
    again = out.intersection(memory.before)
    memory.now.update(zip(again, map(memory.before.__getitem__, again)))
    return out - again


def parts_at_marks(definition: dict, tokenizer) -> bool:
    """Whether letters and the MARKS after them are taken by themselves."""
    first = (_steps(definition.get("pre_tokenizer"), "pretokenizers") or [{}])[0]
    if first.get("type") not in ("Whitespace", "BertPreTokenizer", "Split"):
        return False
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    tails = [*MARKS, *(x + y for x in MARKS for y in MARKS), MARKS]
    return all(ids(x + t) == ids(x) + ids(t) for x in ("a", "the", "Zürich", "中") for t in tails)


class WordEncoder:
    """A tokenizer of the library; ``encode_all`` gives the ids of texts as the bytes that files hold."""

    def __init__(self, data: bytes, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_buffer(data), kind
        definition = json.loads(data)
        self.words = by_words(definition, self.tokenizer)
        self.memory, self.letters = Memory(MEMORY), Memory(MEMORY)
        self.splits = self.words and parts_at_marks(definition, self.tokenizer)
        self.lowers = any(x.get("type") == "Lowercase" for x in _steps(definition.get("normalizer"), "normalizers"))
        suffix = (definition.get("model") or {}).get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def _encoded(self, whole: list[str]) -> Iterator[np.ndarray]:
        for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False):
            yield np.array(e.ids, self.kind)

    def _learn(self, new: list[str]) -> None:
        """Adds the ids of stretches.  One of letters and then marks is its letters' ids and its marks'; letters are looked up in
        lower case if the tokenizer lowers them, and are known from other stretches more often than not."""
        now = self.memory.now
        if self.splits:
            heads = [p.rstrip(MARKS) for p in new]
            whole = [h.isalpha() for h in heads]
            new, rest, heads = list(compress(new, whole)), [p for p, w in zip(new, whole) if not w], list(compress(heads, whole))
            marks = [p[len(h) :] for p, h in zip(new, heads)]
            if self.lowers:
                heads = [h.lower() if h.isascii() else h for h in heads]
            self._encode_letters(list(missing(self.letters, set(heads))))
            found = self.letters.now
            tails = list(missing(self.letters, set(marks)))
            found.update(zip(tails, (ids.tobytes() for ids in self._encoded(tails))))
            look = found.__getitem__
            now.update(zip(new, map(add, map(look, heads), map(look, marks))))
            new = rest
        for k in range(0, len(new), 10_000):
            now.update(zip(new[k : k + 10_000], (ids.tobytes() for ids in self._encoded(new[k : k + 10_000]))))

    def _encode_letters(self, words: list[str]) -> None:
        """Words of letters, many at once: the ids of each end with the only one that may end a stretch.  Were one taken as several,
        there would be more ends, and the group is encoded word by word."""
        size, now = np.dtype(self.kind).itemsize, self.letters.now
        for k in range(0, len(words), 100_000):
            groups = [words[j : j + 500] for j in range(k, min(len(words), k + 100_000), 500)] if self.ends.any() else []
            for group, ids in zip(groups, self._encoded([" ".join(g) for g in groups])):
                at = np.flatnonzero(self.ends[ids]) + 1
                if len(at) == len(group) and at[-1] == len(ids):
                    raw, edge = ids.tobytes(), (np.r_[0, at] * size).tolist()
                    now.update(zip(group, (raw[a:b] for a, b in zip(edge, edge[1:]))))
        rest = [w for w in words if w not in now]
        now.update(zip(rest, (ids.tobytes() for ids in self._encoded(rest))))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        if not self.words:
            for k in range(0, len(texts), 100):
                for ids in self._encoded(texts[k : k + 100]):
                    yield ids.tobytes()
            return
        self.memory.turn()
        self.letters.turn()
        split = [SPACE.split(text) if NOT_SPACE.search(text) else text.split() for text in texts]
        self._learn(list(missing(self.memory, set(chain.from_iterable(split)))))
        look, join = self.memory.now.__getitem__, b"".join
        for pieces in split:
            yield join(map(look, pieces))


_encoders: dict[bytes, WordEncoder] = {}


def word_encoder(data: bytes, kind: str) -> WordEncoder:
    key = hashlib.sha1(data + kind.encode()).digest()
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders.clear()
        _encoders[key] = WordEncoder(data, kind)
    return _encoders[key]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)


def _put(folder: str, name: str, data: bytes) -> None:
    fs, top = _store(folder)
    other = f"{top}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(other) as f:
        f.write(data)
    fs.move(other, f"{top}/{name}")


def _get(folder: str, name: str, kind: str) -> np.ndarray:
    """The file as an array: mapped into memory where the folder is a local one, else read."""
    fs, top = _store(folder)
    if not fs.get_file_info(f"{top}/{name}").size:
        return np.zeros(0, kind)
    if isinstance(fs, pa.fs.LocalFileSystem):
        return np.memmap(f"{top}/{name}", kind, "r")
    with fs.open_input_stream(f"{top}/{name}") as f:
        return np.frombuffer(f.read(), kind)


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int | None = 1, bytes_per_file: int = 48 << 20) -> dict:
    """Writes the files to ``folder`` (shared by all executors); returns the manifest."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship(spark)
    with open(path or default_path(), "rb") as f:
        raw = f.read()
    data = spark.sparkContext.broadcast(raw)
    kind = "<u2" if max(Tokenizer.from_buffer(raw).get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else "<u4"
    size, end = np.dtype(kind).itemsize, b"" if end_id is None else int(end_id).to_bytes(np.dtype(kind).itemsize, "little")
    fs, top = _store(folder)
    fs.create_dir(top, recursive=True)
    rows = keyed(docs)
    ranges = ranges_of(rows, F.octet_length("text"), bytes_per_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(data.value, kind)
        for whole in batches:
            for k in range(0, whole.num_rows, 2500):
                batch = whole.slice(k, 2500)
                ids = pa.array([x + end for x in encoder.encode_all(texts(batch))], pa.binary())
                part = ranges.place(batch.column("doc_id").to_numpy(), batch.column("tie").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), batch.column("doc_id"), batch.column("tie"), ids], names=["p", "doc_id", "tie", "ids"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, doc_ids, sizes, out = -1, [], [], []
        stream = other = None

        def done() -> None:
            stream.close()
            fs.move(other, f"{top}/tokens-{now:06d}.bin")
            lengths = np.concatenate(sizes)
            _put(folder, f"docs-{now:06d}.bin", np.concatenate(doc_ids).astype("<i8").tobytes())
            _put(folder, f"sizes-{now:06d}.bin", lengths.astype("<u8").tobytes())
            out.append((now, len(lengths), int(lengths.sum())))

        for whole in batches:
            parts = whole.column("p").to_numpy()
            edge = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1], True]) if len(parts) else []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                batch = whole.slice(int(a), int(b - a))
                if stream is None or int(parts[a]) != now:
                    if stream is not None:
                        done()
                    now, doc_ids, sizes = int(parts[a]), [], []
                    other = f"{top}/.tokens-{uuid.uuid4().hex}"
                    stream = fs.open_output_stream(other)
                column = batch.column("ids")
                for k in range(len(column)):
                    stream.write(column[k].as_buffer())
                doc_ids.append(batch.column("doc_id").to_numpy())
                sizes.append(pa.compute.binary_length(column).to_numpy().astype(np.int64) // size)
        if stream is not None:
            done()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["p", "n_docs", "n_tokens"])

    dealt = rows.mapInArrow(encode, "p int, doc_id long, tie long, ids binary").repartitionById(ranges.count, "p").sortWithinPartitions("p", "doc_id", "tie", "ids")
    parts = cut(dealt.mapInArrow(keep, "p long, n_docs long, n_tokens long"))  # a row a range
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts.select(F.col("p").alias("part"), "n_docs", "n_tokens", before.cast("long").alias("base")).write.mode("overwrite").parquet(f"{folder}/parts")

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, start in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist()):
                sizes = _get(folder, f"sizes-{p:06d}.bin", "<u8")
                _put(folder, f"offsets-{p:06d}.bin", (np.r_[np.uint64(0), np.cumsum(sizes, dtype=np.uint64)] + np.uint64(start)).astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("part")], names=["part"])

    total = parts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first()
    if total["n"]:
        _parts(spark, folder, total["n"]).mapInArrow(offsets, "part long").count()
    manifest = {"dtype": kind, "n_tokens": total["t"], "end_id": end_id, "n_parts": total["n"]}
    _put(folder, "manifest.json", json.dumps(manifest).encode())
    return manifest


def _parts(spark: SparkSession, folder: str, n: int) -> DataFrame:
    rows = spark.read.schema("part long, n_docs long, n_tokens long, base long").parquet(f"{folder}/parts").select("part", "base")
    return rows.withColumn("k", (F.row_number().over(W.orderBy("part")) - 1).cast("int")).repartitionById(n, "k").drop("k")


def load_manifest(folder: str) -> dict:
    fs, top = _store(folder)
    with fs.open_input_stream(f"{top}/manifest.json") as f:
        return json.loads(f.read())


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers) of each document in the files."""
    ship(spark)
    manifest = load_manifest(folder)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest["n_parts"]:
        return spark.createDataFrame([], schema)
    kind = manifest["dtype"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist()):
                tokens, ids, starts = _get(folder, f"tokens-{p:06d}.bin", kind), _get(folder, f"docs-{p:06d}.bin", "<i8"), _get(folder, f"offsets-{p:06d}.bin", "<u8").astype(np.int64)
                for k in range(0, len(ids), 5000):
                    part = np.array(ids[k : k + 5000])
                    at = starts[k : k + 5001] - base
                    crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(part, mask=part == LEAST), pa.array(starts[k : k + len(part)]), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _parts(spark, folder, manifest["n_parts"]).mapInArrow(walk, schema)


def written_and_read(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` to ``folder`` (a new one in the shared folder by default), and reads the files."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write(docs, folder)
    return read(docs.sparkSession, folder)
