"""Token ids in flat binary files with 64-bit document offsets, read by memory mapping.

A data set is a folder with three files for each part and one table:

* ``part-00000.bin``  ids of the part's documents one after another, little-endian unsigned
  integers of 16 bits where the vocabulary allows it, else of 32 bits;
* ``part-00000.idx``  offsets of the documents in that file, counted in ids, little-endian
  unsigned 64-bit integers, one more than documents;
* ``part-00000.doc``  ids of the documents, little-endian signed 64-bit integers, the
  smallest one standing for null;
* ``manifest``        a Parquet table: part, n_docs, n_tokens and base, the number of ids in
  all earlier parts. The bases are prefix sums over the parts, one row per part.

Documents stand in ascending order of their ids over all parts, nulls first, equal ids by
their text. A part is written under a name of its own and then renamed, and its content
follows from its rows alone, so a part that is written twice (a lost executor, a second
attempt) is the same file again.
"""

import os
import re
import zlib
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from standwise.llm.bpe import LATIN_WORD, ForcedBoundaryBPE
from standwise.llm.common import per_batch, texts

NO_ID = -(2**63)
# Bytes of text that a part is meant to hold.
PART_BYTES = 32 << 20
# Pieces of text that a worker remembers, some 40 bytes each; then it starts anew.
MEMORY = 1_200_000

# Of lines: a run of letters, the mark that closes it, or else the whole line.
_PARTS = re.compile(rf"^{LATIN_WORD.pattern}$|^(.+)$", re.M)
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\f\v"))
# Polynomial hashes of words up to this length; longer ones are not remembered.
LONG = 255
_draw = np.random.default_rng(1)
_LETTER = np.where(_BLANK, 0, _draw.integers(1, 2**64, 256, np.uint64)).astype(np.uint64)
_POWER = np.cumprod(np.full(LONG + 1, 0x9E3779B97F4A7C15, np.uint64))


class LibraryCoder:
    """Ids by the tokenizers library.

    Where a tokenizer file parts words at white space, what stands between two blanks has the
    same ids everywhere: each such piece is encoded once and remembered, in arrays sorted by
    a hash of the piece, and texts are put together from these ids. Runs of lower-case
    letters that are new go to the library as one text, whose ids are parted again after
    each token that ends a word; other pieces go one by one. With other files, and where a
    text holds added tokens, texts are encoded whole.
    """

    GROUP_BYTES = 2 << 20

    def __init__(self, path: str):
        plain = ForcedBoundaryBPE(path)
        self.by_words, self.added = plain.plain_words, plain.added_pattern
        self.letter_runs = plain.letter_runs
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.size = len(plain.names)
        ends = [bool(plain.suffix) and (name or "").endswith(plain.suffix) for name in plain.names]
        self.ends_word = np.array(ends)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.entry = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.start, self.length = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.n_entries, self.n_ids = 0, 0
        self.ids = np.empty(1 << 16, np.uint32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(one.ids, np.uint32) for one in found]

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of new entries with these ids, one after another."""
        while len(self.ids) < self.n_ids + len(ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        starts = self.n_ids + np.cumsum(lengths) - lengths
        self.start = np.concatenate([self.start[: self.n_entries], starts])
        self.length = np.concatenate([self.length[: self.n_entries], lengths])
        numbers = self.n_entries + np.arange(len(lengths))
        self.n_ids, self.n_entries = self.n_ids + len(ids), self.n_entries + len(lengths)
        return numbers

    def _runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their counts of runs of letters, from one call for all of them."""
        ids = self._whole([" ".join(runs)])[0]
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(runs) and ends[-1] == len(ids):
            return ids, np.diff(ends, prepend=0)
        return self._joined(self._whole(runs))

    @staticmethod
    def _joined(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(x) for x in found], np.int64)
        return (np.concatenate(found) if found else np.empty(0, np.uint32)), lengths

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Entries of pieces that are not known."""
        if not self.letter_runs:
            return self._add(*self._joined(self._whole(pieces)))
        parts = _PARTS.findall("\n".join(pieces))
        lower = "\n".join([p[0] for p in parts]).lower().split("\n")
        numbers = np.empty(len(pieces), np.int64)
        bare = [i for i, p in enumerate(parts) if lower[i] == pieces[i]]
        if bare:
            numbers[bare] = self._add(*self._runs([pieces[i] for i in bare]))
        closed = [i for i, p in enumerate(parts) if p[0] and lower[i] != pieces[i]]
        if closed:
            buffer = " ".join([lower[i] for i in closed]).encode()
            runs = self._entries(buffer, *_places(buffer))
            marks = {"": np.empty(0, np.uint32)}
            for mark in {parts[i][1] for i in closed} - {""}:
                marks[mark] = self._whole([mark])[0]
            one = [
                part
                for run, i in zip(runs.tolist(), closed)
                for part in (
                    self.ids[self.start[run] : self.start[run] + self.length[run]],
                    marks[parts[i][1]],
                )
            ]
            lengths = np.array([len(x) for x in one]).reshape(-1, 2).sum(axis=1)
            numbers[closed] = self._add(np.concatenate(one), lengths)
        other = [i for i, p in enumerate(parts) if p[2]]
        if other:
            numbers[other] = self._add(*self._joined(self._whole([pieces[i] for i in other])))
        return numbers

    def _entries(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of every word of a buffer."""
        out = np.empty(len(starts), np.int64)
        blocks = np.searchsorted(starts, np.arange(0, len(buffer), self.GROUP_BYTES))
        for low, high in zip(blocks, [*blocks[1:], len(starts)]):
            if low < high:
                out[low:high] = self._block(buffer, starts[low:high], ends[low:high])
        return out

    def _block(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        data = np.frombuffer(buffer, np.uint8)[starts[0] : ends[-1]]
        heads = starts - starts[0]
        place = np.arange(len(data)) - np.repeat(heads, np.diff(heads, append=len(data)))
        np.minimum(place, LONG, out=place)
        hashes = np.add.reduceat(_LETTER[data] * _POWER[place], heads)
        long = ends - starts > LONG
        different, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, different)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == different if len(self.keys) else np.zeros(len(different), bool)
        numbers = np.where(known, self.entry[at] if len(self.keys) else 0, -1)
        known |= long[first]  # these are seen to below
        new = np.flatnonzero(~known)
        if len(new):
            pieces = [
                buffer[a:b].decode("utf-8", "replace")
                for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            ]
            numbers[new] = self._learn(pieces)
            at = np.searchsorted(self.keys, different[new])
            self.keys = np.insert(self.keys, at, different[new])
            self.entry = np.insert(self.entry, at, numbers[new])
        out = numbers[inverse]
        if long.any():
            pieces = [
                buffer[a:b].decode("utf-8", "replace") for a, b in zip(starts[long], ends[long])
            ]
            out[long] = self._add(*self._joined(self._whole(pieces)))
        return out

    def _group(self, bodies: list[bytes]) -> list[np.ndarray]:
        if self.n_entries > MEMORY:
            self._forget()
        buffer = b" ".join(bodies)
        starts, ends = _places(buffer)
        entries = self._entries(buffer, starts, ends)
        lengths = self.length[entries]
        before = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(before[-1]) + np.repeat(self.start[entries] - before[:-1], lengths)
        ids = self.ids[place]
        heads = np.cumsum([0, *[len(b) + 1 for b in bodies]])
        cuts = before[np.searchsorted(starts, heads)]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, bodies: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts, given as UTF-8."""
        found: list[np.ndarray] = []
        group: list[bytes] = []
        held = 0
        for body in bodies:
            text = None
            if not self.by_words or self.added is not None:
                text = body.decode("utf-8", "replace")
            if text is not None and (not self.by_words or self.added.search(text)):
                found += self._group(group) if group else []
                found += self._whole([text])
                group, held = [], 0
                continue
            group.append(body)
            held += len(body)
            if held > self.GROUP_BYTES:
                found += self._group(group)
                group, held = [], 0
        return found + (self._group(group) if group else [])


def _places(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what stands between blanks."""
    inside = ~_BLANK[np.frombuffer(buffer, np.uint8)]
    edges = np.diff(inside.view(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


@lru_cache(maxsize=2)
def _coder(path: str) -> LibraryCoder:
    return LibraryCoder(path)


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or URI."""
    parts = urlparse(folder)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path) if parts.scheme else folder
    return pafs.FileSystem.from_uri(folder)


def _part(folder: str, part: int, ending: str) -> str:
    return f"{folder}/part-{part:05d}.{ending}"


def write(
    df: DataFrame,
    folder: str,
    path: str,
    end_id: int | None = None,
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode whole texts, write them to a new folder that all machines share, and return
    the manifest. ``end_id`` is appended to every document.

    Null and empty texts hold the end id alone. Repeated rows are written as often as they
    come. An empty table gives an empty manifest.
    """
    spark = df.sparkSession
    rows = texts(df, id_col, text_col)
    # Equal ids are parted by their texts, so one id with many rows doesn't make one part.
    rows = rows.withColumn("tie", F.xxhash64("body"))
    parts = parts or _part_count(spark, rows)
    rows = rows.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie", "body")
    wide = LibraryCoder(path).size > 1 << 16 or (end_id or 0) >= 1 << 16
    kind = "<u4" if wide else "<u2"
    tail = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches):
        model, part = _coder(path), TaskContext.get().partitionId()
        files, place = _store(folder)
        offsets, ids = [0], []
        own = f"{place}/.attempt-{part:05d}-{TaskContext.get().taskAttemptId()}"
        with files.open_output_stream(own) as out:
            for batch in batches:
                bodies = model.encode(batch.column("body").to_pylist())
                for doc, found in zip(batch.column("id").to_pylist(), bodies):
                    found = np.concatenate([found, tail])
                    out.write(found.astype(kind).tobytes())
                    offsets.append(offsets[-1] + len(found))
                    ids.append(NO_ID if doc is None else doc)
        if not ids:
            files.delete_file(own)
            return
        for ending, data in (("idx", np.array(offsets, "<u8")), ("doc", np.array(ids, "<i8"))):
            with files.open_output_stream(f"{own}.{ending}") as out:
                out.write(data.tobytes())
            files.move(f"{own}.{ending}", _part(place, part, ending))
        files.move(own, _part(place, part, "bin"))
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "n_docs": pa.array([len(ids)], pa.int64()),
                "n_tokens": pa.array([offsets[-1]], pa.int64()),
                "bytes_per_id": pa.array([4 if wide else 2], pa.int32()),
            }
        )

    files, place = _store(folder)
    files.create_dir(place, recursive=True)
    schema = "part int, n_docs long, n_tokens long, bytes_per_id int"
    counts = f"{folder}/counts"
    rows.select("id", "body").mapInArrow(run, schema).write.parquet(counts)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    table = spark.read.schema(schema).parquet(counts)
    table = table.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    table.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _part_count(spark: SparkSession, rows: DataFrame) -> int:
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-total // PART_BYTES))


class Part:
    """One part of a data set: documents by position, from memory-mapped files."""

    def __init__(self, folder: str, part: int, bytes_per_id: int):
        self.ids = self._map(folder, part, "bin", f"<u{bytes_per_id}")
        self.offsets = self._map(folder, part, "idx", "<u8")
        self.docs = self._map(folder, part, "doc", "<i8")

    @staticmethod
    def _map(folder: str, part: int, ending: str, kind: str) -> np.ndarray:
        files, place = _store(folder)
        name = _part(place, part, ending)
        if isinstance(files, pafs.LocalFileSystem):
            return np.memmap(name, kind, "r") if os.path.getsize(name) else np.empty(0, kind)
        with files.open_input_file(name) as file:
            return np.frombuffer(file.read(), kind)

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[int(self.offsets[i]) : int(self.offsets[i + 1])]


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files of a data set.

    start counts the ids of all documents before it; the checksum is over the document's
    ids as little-endian unsigned 32-bit integers.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    n = max(spark.sparkContext.defaultParallelism, manifest.count())
    spread = manifest.select("part", "bytes_per_id", "base").repartition(n)
    step = 4096  # documents in an outgoing batch

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                part = Part(folder, row["part"], row["bytes_per_id"])
                for low in range(0, len(part), step):
                    docs = range(low, min(low + step, len(part)))
                    sums = [zlib.crc32(part[i].astype("<u4").tobytes()) for i in docs]
                    span = part.offsets[low : docs.stop + 1].astype("i8")
                    ids = np.array(part.docs[low : docs.stop])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                            "start": pa.array(span[:-1] + row["base"]),
                            "n_tokens": pa.array(np.diff(span)),
                            "ids_crc32": pa.array(sums, pa.int64()),
                        }
                    )

    schema = "id long, start long, n_tokens long, ids_crc32 long"
    return spread.mapInArrow(run, schema).withColumnRenamed("id", id_col)
