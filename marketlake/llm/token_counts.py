"""Token counts of whole texts, huge ones cut in overlapping chunks that are spliced where both sides agree.

A text of at most `chunk` code points is counted in one piece. A longer one is cut every `chunk` code points; each
piece reads on into the next by `overlap` code points and is encoded with offsets, and so is the overlap alone, as
the next piece would see it. Both are searched for a common boundary. The splitter of a byte-level tokenizer goes
from left to right and at a boundary of two of its words it only looks ahead, and merges stay inside its words; so
from a common boundary on both encodings are equal, if it lies far enough before the cut end that what was cut off
could not change it. The piece counts its tokens up to the boundary, less those of the overlap up to there, and the
sum over all pieces is the count of the text.

A piece without a common boundary (the overlap lies in one long word) failed: its cut is given up, so that it
grows by the next piece, and its overlap is widened eightfold; neighbours that fail grow together. This goes on
until all are spliced or reach the text's end. Pieces of all texts are dealt over the cluster; a task holds one
piece, and a text's pieces only meet as sums.

Counting in one piece uses the same property: a single space between two other characters starts a word, so a text
falls into parts that are counted once each and remembered (up to a bound) by the worker.

`tokenizer` is a path that all executors have: .json is read by tokenizers, .model by sentencepiece, without
begin, end or added tokens, truncation or padding; special strings in texts are handled as the library does by
default. For splitters other than the byte-level one without a normaliser, nothing is proven, and texts of any
length are encoded in one piece.

A null or empty text has no tokens. Each row is counted, repeated ones too; a null doc_id stays null. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import chunks, small_batches, stored

#: Code points of a piece, and that it reads on at first.
CHUNK = 16_384
OVERLAP = 512
WIDER = 8
#: Of the splitter: the most code points behind a boundary that decide on it.
AHEAD = 4
#: Tokens from which a text is over the limit.
LIMIT = 1_024
#: Parts whose counts a worker remembers, and code points that the library is given at once.
REMEMBERED = 400_000
AT_ONCE = 500_000
#: Bytes of text that a task holds at once.
STEP = 4_000_000
#: Copies of the count of a huge text, of which there may be many rows.
SALTS = 16
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


class Library:
    """A tokenizer file with what is needed of it: counts, and where its words end."""

    def __init__(self, path: str):
        self.proven, self.margin = False, 0
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._sizes = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        # a task has one core, and forked workers must not wait for threads they do not have
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        self._sizes = lambda texts: [len(x) for x in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        splitter, special = said.get("pre_tokenizer") or {}, said.get("added_tokens") or []
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in special)
        first = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter["add_prefix_space"]
        self.proven = bool(first and plain and not said.get("normalizer") and not said.get("post_processor"))
        self.margin = AHEAD + max((len(t["content"]) for t in special), default=0)

    def sizes(self, texts: list[str]) -> list[int]:
        """Tokens of each text, all by the library."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= AT_ONCE:
                out += self._sizes(held)
                held, size = [], 0
        return out + (self._sizes(held) if held else [])

    def _remember(self, counts: dict[str, int], parts: set[str], before: str) -> None:
        new = [p for p in parts if p not in counts]
        counts.update(zip(new, self.sizes([before + p for p in new]), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.proven:
            return self.sizes(texts)
        for counts in (self.first, self.later):
            if len(counts) > REMEMBERED:
                counts.clear()
        cut = [_BETWEEN.split(text) for text in texts]
        self._remember(self.first, {parts[0] for parts in cut}, "")
        self._remember(self.later, {p for parts in cut for p in parts[1:]}, " ")
        return [self.first[parts[0]] + sum(map(self.later.__getitem__, parts[1:])) for parts in cut]

    def ends(self, text: str, start: int, stop: int) -> tuple[int, dict[int, int]]:
        """All tokens of `text`; and the tokens up to each end of a word from `start` to `stop`."""
        encoded = self.encoder.encode(text, add_special_tokens=False)
        word, offsets, n = encoded.word_ids, encoded.offsets, len(encoded)
        out = {0: 0} if start <= 0 else {}
        for k in range(n - 1, -1, -1):
            end = offsets[k][1]
            if end < start:
                break
            if end <= stop and (k == n - 1 or word[k] != word[k + 1]):
                out[end] = k + 1
        return n, out

    def spliced(self, text: str, inner: int | None, to_end: bool) -> int | None:
        """Tokens that a piece adds: those up to a common boundary, less those of its overlap, which starts at `inner`.

        None if there is no such boundary. inner None: the text's last piece, which counts to its end.
        """
        if inner is None:
            return self.counts([text])[0]
        stop = len(text) if to_end else len(text) - self.margin
        _, own = self.ends(text, inner, stop)
        _, next_one = self.ends(text[inner:], 0, stop - inner)
        common = [end for end in next_one if end + inner in own]
        return own[min(common) + inner] - next_one[min(common)] if common else None


@functools.lru_cache(maxsize=4)
def library(path: str) -> Library:
    return Library(path)


def _counted(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, STEP):
            sizes = library(path).counts(part["text"].cast(pa.string()).to_pylist())
            yield pa.record_batch(
                [part["doc_id"].combine_chunks(), part["n_bytes"].combine_chunks(), pa.array(sizes, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return count


PIECE = "digest string, start long, inner long, to_end boolean, reach long, text string"


def _cut(chunk: int):
    """Huge texts -> their pieces; of a text with given-up cuts only the pieces that have grown by them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PIECE.split(", ")]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string())
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*held, strict=True), kinds, strict=True)], names)

        for rows in batches:
            for k in range(rows.num_rows):
                digest, dropped, reach = (rows[c][k].as_py() for c in ("digest", "dropped", "reach"))
                text = rows["text"][k].as_py()
                gone = set(dropped or ())
                starts = [s for s in range(0, len(text), chunk) if s not in gone]
                for s, end in zip(starts, [*starts[1:], None], strict=True):
                    if gone and (s + chunk) not in gone:
                        continue
                    stop = len(text) if end is None else min(len(text), end + reach)
                    held.append((digest, s, None if end is None else end - s, stop == len(text), reach, text[s:stop]))
                    size += stop - s
                    if size >= STEP // 4:
                        yield batch()
                        held, size = [], 0
        if held:
            yield batch()

    return cut


def _spliced(path: str):
    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, STEP):
            own = library(path)
            found = [
                own.spliced(text, inner, to_end)
                for text, inner, to_end in zip(part["text"].cast(pa.string()).to_pylist(), part["inner"].to_pylist(), part["to_end"].to_pylist(), strict=True)
            ]
            kept = [part[c].combine_chunks() for c in ("digest", "start", "inner", "reach")]
            yield pa.record_batch([*kept, pa.array(found, pa.int64())], ["digest", "start", "inner", "reach", "tokens"])

    return splice


def _pieces(huge: DataFrame, path: str, chunk: int, name: str) -> DataFrame:
    """digest, start, inner, reach, tokens (null: not spliced) of each piece, once for equal texts."""
    cut = huge.select("digest", "text", "dropped", "reach").mapInArrow(_cut(chunk), PIECE)
    # a piece is a row of its own; they go round and round to all tasks, copies of one text as well
    tasks = int(huge.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.repartition(tasks).withColumn("text", F.col("text").cast("binary"))
    done = dealt.select("digest", "start", "inner", "to_end", "reach", "text").mapInArrow(
        _spliced(path), "digest string, start long, inner long, reach long, tokens long"
    )
    return stored(done.groupBy("digest", "start", "inner", "reach").agg(F.max("tokens").alias("tokens")), name)


def huge_counts(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """digest, n_tokens of each different text of `huge` (digest, text), by pieces."""
    plain = huge.withColumns({"dropped": F.lit(None).cast("array<long>"), "reach": F.lit(overlap).cast("long")})
    pieces = done = _pieces(plain, path, chunk, "token-pieces")
    gone = None
    while True:
        failed = done.where("tokens is null").select("digest", (F.col("start") + F.col("inner")).alias("at"), "reach")
        if not failed.head(1):
            break
        gone = stored(failed if gone is None else gone.unionByName(failed), "token-cuts")
        again = gone.groupBy("digest").agg(F.collect_set("at").alias("dropped"), (F.max("reach") * WIDER).alias("reach"))
        done = _pieces(huge.join(stored(again, "token-again"), "digest"), path, chunk, "token-pieces")
        pieces = pieces.unionByName(done)
    pieces = pieces.where("tokens is not null")
    if gone is not None:
        pieces = pieces.join(gone.select("digest", F.col("at").alias("start")).distinct(), ["digest", "start"], "left_anti")
    # a piece that has grown in a round is counted by its last round
    last = pieces.groupBy("digest", "start").agg(F.max_by("tokens", "reach").alias("tokens"))
    return last.groupBy("digest").agg(F.sum("tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens) of each row."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    if not library(tokenizer).proven:
        counted = rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(_counted(tokenizer), "doc_id long, n_bytes long, n_tokens long")
        return counted.withColumn("over_limit", F.col("n_tokens") > limit)
    whole = rows.where(F.char_length("text") <= chunk).withColumn("text", F.col("text").cast("binary"))
    counted = whole.mapInArrow(_counted(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    huge = rows.where(F.char_length("text") > chunk).withColumn("digest", F.sha2("text", 256))
    sums = huge_counts(huge.select("digest", "text"), tokenizer, chunk, overlap)
    # copies of one huge text may be many rows: they meet its count in several groups
    copies = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = huge.select("doc_id", "n_bytes", "digest").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    long_ones = salted.join(copies, ["digest", "salt"]).select("doc_id", "n_bytes", "n_tokens")
    return counted.union(long_ones).withColumn("over_limit", F.col("n_tokens") > limit)
