"""Token files: flat unsigned ids and 64-bit document offsets, in shards written by tasks.

A shard holds a range of document ids in ascending order as three flat little-endian files: ``.ids``
(unsigned 16 bits where every id fits, else 32), ``.offsets`` (unsigned 64, one more than documents,
from the shard's first id) and ``.docs`` (signed 64-bit document ids, the smallest value for null).
Files carry the task attempt in their names; the manifest, which Spark commits, names those of the
attempts that counted, with the prefix sum of ids before each shard. Readers map the files to memory
where they are local or mounted, and read ranges elsewhere.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlake.llm.components import stored
from flowlake.llm.tasks import pieces, small_batches
from flowlake.llm.words import Words, split_words, word_array

#: Shards have this size until there are MAX_SHARDS of them, and grow with the corpus from there on.
SHARD_BYTES, MAX_SHARDS = 12 << 20, 50_000
#: Text encoded at once, and words kept between batches by one Python worker.
PIECE, KNOWN_WORDS = 1 << 21, 600_000
NO_ID = np.iinfo(np.int64).min
MANIFEST = "shard int, name string, width int, documents long, tokens long"
#: Normalizers that work on each character run by itself, so a cut at white space changes nothing.
LOCAL = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}


def drops_spaces(tokenizer: str) -> bool:
    """Whether a tokenizer file says that white space parts words and makes no token itself."""
    parts = json.loads(tokenizer)

    def parted(step):
        if step["type"] == "Split" and step["behavior"] == "Removed" and step["invert"]:
            pattern = step["pattern"].get("Regex")
            return pattern is not None and not any(regex.search(pattern, space) for space in " \t\n\v\f\r")
        return step["type"] in ("Whitespace", "WhitespaceSplit")

    def local(step):
        return step["type"] in LOCAL or step == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}

    first = _steps(parts["pre_tokenizer"], "pretokenizers")[:1]
    plain = all(not t["lstrip"] and not t["rstrip"] and not re.search(r"\s", t["content"]) for t in parts["added_tokens"])
    return plain and all(map(local, _steps(parts["normalizer"], "normalizers"))) and bool(first) and parted(first[0])


SIGNS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def cuts_signs(tokenizer: str) -> bool:
    """Whether a tokenizer file lowers letters and parts a word of letters from the signs after it."""
    parts = json.loads(tokenizer)
    lowers = parts["normalizer"] is not None and any(step == {"type": "Lowercase"} for step in _steps(parts["normalizer"], "normalizers"))
    first = _steps(parts["pre_tokenizer"], "pretokenizers")[0]
    if not lowers or first["type"] != "Split" or parts["model"]["type"] != "BPE" or parts["model"].get("dropout"):
        return False
    cut = lambda word: regex.findall(first["pattern"]["Regex"], word)
    return all(cut(letters + tail) == [letters, tail] for letters in ("ab", "z", "né") for tail in (*SIGNS, SIGNS, SIGNS[::-1]))


def _steps(part, inner: str) -> list:
    """The steps of a normalizer or pre-tokenizer, without nesting."""
    if part is None:
        return []
    return [x for p in part[inner] for x in _steps(p, inner)] if part["type"] == "Sequence" else [part]


@cache
def _classes():
    """ASCII letters, ASCII signs, and last bytes of the letters from U+00C0 to U+00FF."""
    letter, sign, latin = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123)]] = True
    sign[[ord(c) for c in SIGNS]] = True
    latin[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = True  # without the two signs of arithmetic
    return letter, sign, latin


def split_signs(words: Words) -> Words:
    """Cut tails of ASCII signs off words whose letters end there, and lower words of ASCII letters.

    A word with a < stays as it is: it may hold a special token.
    """
    letter, sign, latin = _classes()
    data, start, end = words.data, words.start, words.end
    if not len(start):
        return words
    signs, letters = sign[data], np.concatenate([[0], np.cumsum(letter[data], dtype=np.int32)])
    last = np.maximum.accumulate(np.where(signs, 0, np.arange(1, len(data) + 1, dtype=np.int32)))
    cut = np.maximum(last[end - 1], start)
    before, lead = data[np.maximum(cut - 1, 0)], data[np.maximum(cut - 2, 0)]
    ends = letter[before] | (latin[before] & (lead == 0xC3) & (cut - 2 >= start))
    cut = np.where(ends & (cut > start), cut, end)
    special = data == 0x3C
    if special.any():
        held = np.concatenate([[0], np.cumsum(special, dtype=np.int32)])
        cut = np.where(held[end] > held[start], end, cut)
    plain = letters[cut] - letters[start] == cut - start
    tails = cut < end
    place = np.arange(len(start)) + np.cumsum(tails) - tails
    total = len(start) + int(tails.sum())
    low, high = np.empty(total, start.dtype), np.empty(total, start.dtype)
    low[place], high[place] = start, cut
    low[place[tails] + 1], high[place[tails] + 1] = cut[tails], end[tails]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start[plain]] += 1
    edge[cut[plain]] -= 1
    lowered = data | ((np.cumsum(edge[:-1], dtype=np.int8) > 0) & (data < 91) & letter[data]).astype(np.uint8) << 5
    return Words(lowered, low, high, words.hash, np.append(place, total)[words.first])


class WordEncoder:
    """Ids of texts.

    A tokenizer that drops white space gets every distinct word once while it is remembered: texts are cut at
    bytes 0x20 and 0x09 to 0x0D, Arrow numbers the distinct words of a batch, and the ids of all
    words are gathered by these numbers. Any other tokenizer gets the texts whole.

    Where the tokenizer's file says so, a tail of ASCII signs after a letter is a word of its own, and words of
    ASCII letters are lowered with the bytes of the batch and go straight to the merges, as no other step changes them. Words
    with other letters are encoded many in one call: each ends with the one token that closes a word, and
    a call whose closing tokens are not as many as its words is done again word by word.
    """

    def __init__(self, text: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encoder, self.kind, self.known = Tokenizer.from_str(text), kind, {}
        self.words = drops_spaces(text)
        self.lowers = self.words and cuts_signs(text)
        self._merges = self.encoder.model.tokenize
        vocabulary = self.encoder.get_vocab(with_added_tokens=True)
        suffix = getattr(self.encoder.model, "end_of_word_suffix", None)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.closes[[k for token, k in vocabulary.items() if token.endswith(suffix)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian."""
        ids, counts = self.ids(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []

    def ids(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow column, one after the other, and how many each text has."""
        if not self.words:
            found = self.encoder.encode_batch_fast([t or "" for t in column.to_pylist()], add_special_tokens=False)
            ids = [np.array(f.ids, self.kind) for f in found]
            return np.concatenate([np.zeros(0, self.kind), *ids]), np.array([len(x) for x in ids], np.int64)
        words = split_words(column, hashed=False)
        words = split_signs(words) if self.lowers else words
        numbered = word_array(words).dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        code = numbered.indices.to_numpy()
        known = self.known
        missing = [word for word in distinct if word not in known]
        self._learn(missing)
        coded = list(map(known.__getitem__, distinct))
        if len(known) > KNOWN_WORDS:
            known.clear()
        else:
            for word in missing:
                if len(word) > 64:  # not worth the room
                    del known[word]
        flat = np.frombuffer(b"".join(coded), self.kind)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // flat.itemsize
        first = np.cumsum(sizes) - sizes
        count = sizes[code]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(first[code] - ends + count, count) + np.arange(total)]
        return ids, np.diff(np.concatenate([[0], ends])[words.first])

    def _learn(self, words: list[str]) -> None:
        known, merges, kind = self.known, self._merges, self.kind
        letters, rest = [], []
        for word in words:
            if self.lowers and word.isascii() and word.isalpha():
                known[word] = np.array([t.id for t in merges(word.lower())], kind).tobytes()
            elif word.isalpha() and word.lower().isalpha():
                letters.append(word)
            else:
                rest.append(word)
        for at in range(0, len(letters), 500):
            self._together(letters[at : at + 500])
        self._each(rest)

    def _together(self, words: list[str]) -> None:
        ids = np.array(self.encoder.encode(" ".join(words), add_special_tokens=False).ids, self.kind)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            self._each(words)
            return
        flat, width, start = ids.tobytes(), ids.itemsize, 0
        for word, end in zip(words, (ends * width).tolist()):
            self.known[word] = flat[start:end]
            start = end

    def _each(self, words: list[str]) -> None:
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            for word, found in zip(part, self.encoder.encode_batch_fast(part, add_special_tokens=False)):
                self.known[word] = np.array(found.ids, self.kind).tobytes()


@cache
def word_encoder(text: str, kind: str) -> WordEncoder:
    return WordEncoder(text, kind)


def _file_system(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _read(fs, path: str):
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Encode every text, append ``end_id``, write the shards; the manifest, one row per shard.

    ``tokenizer`` is the path of a tokenizer file; one that drops white space is much faster. Null and
    empty texts are the end id alone, a text longer than a batch is encoded as a whole; repeated rows are written again; rows with a null id come first. Other columns are
    ignored. An empty table gives no shard. ``path`` lies in storage that all executors reach.
    """
    vocabulary = Path(tokenizer).read_text()
    size = Tokenizer.from_str(vocabulary).get_vocab_size(with_added_tokens=True)
    kind = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total_bytes = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(24, min(MAX_SHARDS, -(-total_bytes // shard_bytes)))
    tie = F.xxhash64("text")
    dealt = slim.repartitionByRange(shards, F.col("id"), tie).sortWithinPartitions("id", tie, "text")
    width = np.dtype(kind).itemsize

    def write(batches):
        task = TaskContext.get()
        shard = task.partitionId()
        name = f"shard-{shard:06d}-{task.taskAttemptId()}"
        fs, folder = _file_system(path)
        encoder = word_encoder(vocabulary, kind)
        offsets, ids, out, total = [np.zeros(1, np.uint64)], [], None, 0
        for piece in pieces(batches, "text", PIECE):
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(f"{folder}/{name}.ids")
            column = piece.column(0)
            ids.append(np.asarray(column.fill_null(int(NO_ID))).astype("<i8"))
            coded, counts = encoder.ids(piece.column(1))
            out.write(np.insert(coded, np.cumsum(counts), end_id).astype(kind, copy=False).tobytes())
            offsets.append(total + np.cumsum(counts.astype(np.uint64) + np.uint64(1), dtype=np.uint64))
            total = int(offsets[-1][-1])
        if out is None:
            return
        out.close()
        for suffix, parts in (("offsets", offsets), ("docs", ids)):
            with fs.open_output_stream(f"{folder}/{name}.{suffix}") as f:
                f.write(np.concatenate(parts).tobytes())
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "name": [name], "width": pa.array([width], pa.int32()),
             "documents": [sum(map(len, ids))], "tokens": [total]}
        )

    return with_bases(stored(dealt.mapInArrow(write, MANIFEST), "manifest"), path)


def with_bases(manifest: DataFrame, path: str) -> DataFrame:
    """Add ``base``, the ids of all shards before, and write the manifest beside the shards."""
    rows = sorted(manifest.collect())  # one row per shard, MAX_SHARDS at most
    bases = np.concatenate([[0], np.cumsum([r.tokens for r in rows])]).tolist()
    spark = manifest.sparkSession
    full = spark.createDataFrame([(*r, b) for r, b in zip(rows, bases)], MANIFEST + ", base long")
    full.coalesce(1).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files alone.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian unsigned 32-bit
    integers, the end id included.
    """
    manifest = spark.read.parquet(f"{path}/manifest")
    count = max(1, manifest.count())

    def read(batches):
        fs, folder = _file_system(path)
        for batch in batches:
            for row in batch.to_pylist():
                base = f"{folder}/{row['name']}"
                kind, width = np.dtype(f"<u{row['width']}"), row["width"]
                with _read(fs, f"{base}.ids") as ids, _read(fs, f"{base}.offsets") as offsets, _read(fs, f"{base}.docs") as docs:
                    at = 0
                    while at < row["documents"]:
                        upto = min(at + 512, row["documents"])
                        ends = np.frombuffer(offsets.read_at((upto - at + 1) * 8, at * 8), "<u8").astype(np.int64)
                        if upto > at + 1 and ends[-1] - ends[0] > 1 << 21:
                            upto = at + max(1, int(np.searchsorted(ends, ends[0] + (1 << 21), "right")) - 1)
                            ends = ends[: upto - at + 1]
                        flat = np.frombuffer(ids.read_at(int(ends[-1] - ends[0]) * width, int(ends[0]) * width), kind).astype("<u4")
                        doc = np.frombuffer(docs.read_at((upto - at) * 8, at * 8), "<i8")
                        bounds = ((ends - ends[0]) * 4).astype(np.int32)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(doc, mask=doc == NO_ID),
                                pa.array(ends[:-1] + row["base"]),
                                pa.array(np.diff(ends)),
                                pa.Array.from_buffers(pa.binary(), upto - at, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat.tobytes())]),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )
                        at = upto

    dealt = manifest.repartitionByRange(count, "shard")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
