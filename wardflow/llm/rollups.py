"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas:
an insert adds a document and its tokens, a delete takes them away, a revised
count adds the difference.  Tokens are counted by public tokenizer files, in
Arrow batches.

A batch of changes is aggregated into a staged folder and committed under its
id by one rename, so it counts whole or not at all, and a batch that is
committed already is not written again.  ``compact`` merges what is committed
into a base, which remembers the ids of its batches.
"""

from __future__ import annotations

import os
import sys
import types
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm import token_ids
from wardflow.llm.common import ship_by_value

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

#: Tokenizer versions: their names are the vocabulary files they count by.
TOKENIZERS = ("word_bpe_49k.json", "byte_bpe_50k.tiktoken")


def tokenizer_file(version: str) -> str:
    """Where a version's file lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path(version)


def _counter(version: str, content: bytes) -> Callable[[pa.Array], list[int]]:
    """Function that counts the tokens of an Arrow column of texts."""
    if version.endswith(".json"):
        tok = token_ids.worker_tokenizer(content.decode())
        return lambda texts: [len(ids) // 4 for ids in tok.batch_ids(texts)]
    kept = sys.modules.setdefault("_rank_tokenizers", types.ModuleType("_rank_tokenizers")).__dict__
    if version not in kept:
        import base64

        import public_tokenizers
        import tiktoken
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, content.splitlines())}
        kept[version] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = kept[version].encode_ordinary
    return lambda texts: [len(encode(t.as_py() or "")) for t in texts]


def with_token_counts(df: DataFrame, keep: list[Column], texts: dict[str, Column], versions: tuple[str, ...] = TOKENIZERS,
                      path: Callable[[str], str] = tokenizer_file) -> DataFrame:
    """The columns ``keep``, and for every tokenizer version a row with
    ``tokenizer`` and a count for each of ``texts`` (new name = text).

    Null and empty texts have 0 tokens, a text that a special token's
    characters are part of is ordinary text; texts are tokenized whole,
    however long; repeated rows are counted each; an empty table gives no
    rows; other columns are not looked at.
    """
    ship_by_value(__name__)
    ship_by_value(token_ids.__name__)
    files = {}
    for v in versions:
        with open(path(v), "rb") as f:
            files[v] = f.read()
    given = df.sparkSession.sparkContext.broadcast(files)  # a few tokenizer files
    inp = df.select(*keep, *[t.alias(f"__{n}") for n, t in texts.items()])
    n_texts = len(texts)
    n_keep = len(inp.columns) - n_texts
    out = T.StructType([*inp.schema.fields[:n_keep], T.StructField("tokenizer", T.StringType()),
                        *[T.StructField(n, T.LongType()) for n in texts]])

    def run(batches):
        counters = {v: _counter(v, content) for v, content in given.value.items()}
        for b in batches:
            for v, count in counters.items():
                counts = [pa.array(count(b.column(n_keep + k)), pa.int64()) for k in range(n_texts)]
                yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], pa.array([v] * b.num_rows), *counts], names=out.names)

    return inp.mapInArrow(run, out)


def changes(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """Signed deltas (keys, n_docs, n_tokens) that turn the counted documents
    ``before`` (keys, n_tokens) into ``after``: None before is an insert,
    None after a delete, both a revision.  Null counts are 0; null keys are
    keys like any others; repeated rows count each."""
    def signed(df, sign):
        return df.select(*[F.col(k).cast("string").alias(k) for k in KEYS], F.lit(sign).cast("long").alias("n_docs"),
                         (sign * F.coalesce(F.col("n_tokens"), F.lit(0))).cast("long").alias("n_tokens"))
    parts = [signed(df, sign) for df, sign in ((before, -1), (after, 1)) if df is not None]
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def _summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class TokenRollup:
    """Totals in a folder that all executors share: ``batch-<id>`` and
    ``base-<number>`` folders, each there from one rename on; what is still
    being written has a name that Spark's readers pass over."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folder(self, batch_id: str) -> str:
        return f"{self.path}/batch-{quote(batch_id, safe='')}"

    def _complete(self, folder: str) -> bool:
        return self._fs.exists(self._path(folder + "/_SUCCESS"))

    def _names(self, kind: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{self.path}/{kind}-*")) or []
        return [f.getPath().getName()[len(kind) + 1:] for f in found]

    def _rename(self, staged: str, folder: str) -> bool:
        """Whether ``staged`` became ``folder``; a store may move it into a
        folder that another writer put there first, and then it goes."""
        moved = self._fs.rename(self._path(staged), self._path(folder))
        inside = self._path(f"{folder}/{os.path.basename(staged)}")
        lost = self._fs.exists(inside)
        self._fs.delete(inside if lost else self._path(staged), True)
        return moved and not lost

    def _stage(self, deltas: DataFrame) -> str:
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        _summed(deltas).write.parquet(staged)
        return staged

    def _base(self) -> tuple[str | None, set[str]]:
        """The latest base's folder and the ids of the batches in it."""
        bases = [int(n) for n in self._names("base")]
        if not bases:
            return None, set()
        folder = f"{self.path}/base-{max(bases)}"
        inside = self.spark.read.schema("id string").parquet(f"{folder}/_ids")
        return folder, {r.id for r in inside.collect()}  # one short row a batch

    def committed(self, batch_id: str) -> bool:
        return self._complete(self._folder(batch_id)) or batch_id in self._base()[1]

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Commit a batch once; False if it was committed before, or by
        another writer meanwhile.  Deltas are summed before they are
        shuffled, so a hot source is one row a task."""
        if self.committed(batch_id):
            return False
        folder = self._folder(batch_id)
        staged = self._stage(deltas)
        if self._fs.exists(self._path(folder)) and not self._complete(folder):
            self._fs.delete(self._path(folder), True)  # not a committed batch
        return self._rename(staged, folder)

    def _parts(self) -> tuple[list[str], set[str]]:
        """The folders that make up the totals, and all ids counted in them."""
        base, inside = self._base()
        new = {i for i in map(unquote, self._names("batch")) if i not in inside and self._complete(self._folder(i))}
        return [base] * (base is not None) + [self._folder(i) for i in sorted(new)], inside | new

    def totals(self) -> DataFrame:
        """(keys, n_docs, n_tokens) over all committed batches; keys whose
        documents are all gone are left out.  No batch: no rows."""
        folders = self._parts()[0]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return _summed(self.spark.read.schema(SCHEMA).parquet(*folders)).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Merge all committed batches into a new base, one compaction at a
        time.  The base before it and the batches merged just now stay for
        readers that still hold them; what the base before had merged goes."""
        before, inside = self._base()
        folders, ids = self._parts()
        if not ids - inside:
            return
        number = 1 + max([int(n) for n in self._names("base")], default=0)
        staged = self._stage(self.spark.read.schema(SCHEMA).parquet(*folders))
        self.spark.createDataFrame([(i,) for i in sorted(ids)], "id string").coalesce(1).write.parquet(f"{staged}/_ids")
        if self._rename(staged, f"{self.path}/base-{number}"):
            for i in inside:
                self._fs.delete(self._path(self._folder(i)), True)
            for n in self._names("base"):
                if int(n) < number - 1:
                    self._fs.delete(self._path(f"{self.path}/base-{n}"), True)
