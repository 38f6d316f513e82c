"""The model tables, computed once and shared by all sessions.

The shipped lines (lineitem joined to orders), the weekly sales sums, promotions,
market share and the document tables are parquet under the shared folder
(``session.shared_root``), named by a versioned manifest (``sources.versions``).  The
manifest records for each table the parts it consists of and the inputs each was
made from: files of the source tables, or parts of another model table.  A second
session finds the manifest and builds nothing.  When inputs were only added, a table
is maintained, not rebuilt:

* lines: new lineitem files are joined to all orders, and the lineitem files known
  before to the new orders files; the result is one more part.
* sales: the new parts of lines alone are aggregated; their sums are merged with the
  stored ones in the months they touch, other months stay as they are.  Sums are
  stored unrounded, so the merge is exact.
* documents, their term positions, vectors: the new files alone are read.

Other tables (promotions, whose baseline is a mean over all lines; market share; the
term index) are rebuilt from the maintained ones.  An input that was changed or
removed rebuilds what depends on it.  ``Model.build`` builds explicitly; an accessor
whose table is current only returns a scan.  Parts are immutable, so a session that
reads an older version is not disturbed, and the root folder's name carries a digest
of the defining code, so other code's parts are not read; versions are removed with the parts only
they name when they were replaced more than ``KEEP_SECONDS`` ago.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import importlib
import inspect
import json
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import columns as C
from shelfline.functions import vectors as VX
from shelfline.session import shared_root
from shelfline.sources import views as V
from shelfline.sources.tables import SCHEMAS, table_path
from shelfline.sources.versions import KEEP_SECONDS, Files, Versions

#: What a table is made from: source tables, or model tables.
INPUTS = {"lines": ("lineitem", "orders"), "sales": ("lines",), "promotions": ("lines",),
          "market_share": ("lines", "part"), "documents": ("documents",), "doc_index": ("documents",), "doc_blocks": ("doc_index",),
          "doc_positions": ("documents",), "pivots": ("embeddings",), "vectors": ("embeddings", "pivots"), "store_sketches": ("lines",),
          "memory_log": ("events",), "chat": ("conversations",)}
MODEL_INPUTS = {("sales", "lines"), ("promotions", "lines"), ("market_share", "lines"), ("store_sketches", "lines"),
                ("doc_blocks", "doc_index"), ("vectors", "pivots")}
ORDER = {"market_share": ("month", "brand"),
         "doc_positions": ("term", "following", "doc_id"), "vectors": ("doc_id",)}
#: Tables of which each file is in order: pages of a file are skipped, and rows are not
#: shuffled once more for it.
FILE_ORDER = {"promotions": ("start_date", "product_id"), "documents": ("doc_id",), "doc_index": ("term", "doc_id"),
              "doc_blocks": ("term", "block")}
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"              # the folder of rows without a date
#: The greatest value of a column is recorded with the table, so that trailing
#: windows are literals.
GREATEST = {"sales": "week_ending", "promotions": "start_date", "market_share": "month", "chat": "session_id"}
CODEC = "zstd"
#: Buckets of the chat, by session: a session's history is read from one of them.
CHAT_BUCKETS = 16


@functools.cache
def definition() -> str:
    """A digest of the code that defines the tables: parts that other code made are not
    read."""
    parts = [inspect.getsource(sys.modules[__name__]),
             *(inspect.getsource(importlib.import_module(f"shelfline.{m}")) for m in
               ("sources.views", "functions.columns", "functions.vectors", "operators.text", "operators.share", "operators.memory",
                "operators.retrieval"))]
    return hashlib.md5("".join(parts).encode()).hexdigest()[:12]


class Model:
    """The consumer-goods model over one source folder."""

    def __init__(self, spark: SparkSession, sf: str, keep_seconds: float = KEEP_SECONDS):
        self.spark, self.sf, self.keep_seconds = spark, sf.rstrip("/"), keep_seconds
        self.root = f"{shared_root(spark)}/shelfline-model-{definition()}/{hashlib.md5(self.sf.encode()).hexdigest()}"
        self.files, self.versions = Files(spark), Versions(spark, f"{self.root}/manifest")
        self.made: list[str] = []                       # tables built or maintained by this handle
        self._entries: dict[str, dict] = {}

    # ---- the manifest

    def build(self, *tables: str) -> Model:
        """Bring tables (without names: all) up to date now; returns the handle."""
        for name in tables or INPUTS:
            self._entry(name)
        return self

    def _entry(self, name: str) -> dict:
        """The current manifest entry of a table, built or maintained if need be.
        A handle looks at a table's inputs once: it reads one state of them."""
        if name in self._entries:
            return self._entries[name]
        known = self.versions.latest()[1].get(name)
        inputs = {source: self._entry(source)["parts"] if (name, source) in MODEL_INPUTS
                  else self.files.listing(table_path(self.sf, source)) for source in INPUTS[name]}
        if known and not all(self.files.exists(p) for p in {self._folder(p) for p in known["parts"]}):
            known = None                                # removed from outside
        if not known or known["inputs"] != inputs:
            entry = self._make(name, inputs, known)
            self.made.append(name)
            self.versions.publish(lambda current: current | {name: entry})
            self._clean()
        else:
            entry = known
        self._entries[name] = entry
        return entry

    def _folder(self, part: str) -> str:
        """The written folder that a part is, or lies in."""
        return "/".join(part.split("/")[:self.root.count("/") + 2])

    def _clean(self) -> None:
        """Remove old versions and the parts that no version names any more."""
        gone = [e for version in self.versions.retire(self.keep_seconds) for e in version.values()]
        if gone:
            kept = {p for n in self.versions._numbers() for e in json.loads(
                self.files.read(self.versions._path(n)))["content"].values() for p in e["parts"]}
            folders = {self._folder(p) for p in kept}
            for part in {p for e in gone for p in e["parts"]} - kept:
                self.files.delete(self._folder(part) if self._folder(part) not in folders else part)

    # ---- building and maintaining

    def _make(self, name: str, inputs: dict, known: dict | None) -> dict:
        added = {s: [i for i in inputs[s] if i not in known["inputs"][s]] for s in inputs} if known else {}
        grown = bool(known) and all(all(i in inputs[s] for i in known["inputs"][s]) for s in inputs)
        extend = getattr(self, f"_extend_{name}", None) if grown else None
        if extend:
            parts, fresh, schema = extend(inputs, added, known)
        else:
            df = getattr(self, f"_make_{name}")(inputs)
            parts = fresh = self._write(df, name, months=name == "sales")
            schema = df.drop("month").schema.json() if name == "sales" else df.schema.json()
        entry = {"inputs": inputs, "parts": parts, "schema": schema}
        if name in GREATEST:
            top = self._read(fresh, schema).agg(F.max(GREATEST[name])).first()[0] if fresh else None
            found = [known["greatest"] if extend else None, top.isoformat() if isinstance(top, dt.date) else top]
            entry["greatest"] = max((x for x in found if x is not None), default=None)
        return entry

    def _write(self, df: DataFrame, name: str, months: bool = False) -> list[str]:
        """Write immutable parts; their paths.  Sorted rows let range filters on
        the leading column skip files and row groups; adaptive execution merges
        ranges by bytes."""
        path = f"{self.root}/model-{name}-{uuid.uuid4().hex[:12]}"
        if months:
            (df.sortWithinPartitions("month", "week_ending", "product_id").write.option("compression", CODEC)
             .partitionBy("month").parquet(path))
            found = [f"{path}/{n}" for n in self.files.names(path) if n.startswith("month=")]
            return found or [path]
        if name == "chat":
            # a hot session spreads over tasks, each of which writes its rows of a bucket
            (df.repartitionByRange("session_id", "turn").write.bucketBy(CHAT_BUCKETS, "session_id").sortBy("session_id", "turn")
             .option("path", path).saveAsTable(self._bucketed(path, df.schema.json(), declare=False)))
            return [path]
        if name in ORDER:
            df = df.repartitionByRange(*ORDER[name]).sortWithinPartitions(*ORDER[name])
        if name in FILE_ORDER:
            df = df.sortWithinPartitions(*FILE_ORDER[name])
        df.write.option("compression", CODEC).parquet(path)
        return [path]

    def _bucketed(self, path: str, schema: str, declare: bool = True) -> str:
        """The catalog name of a bucketed folder; each session declares it for itself."""
        name = f"shelfline_model_{path.rsplit('-', 1)[1]}"
        if declare and not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(schema)))
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (session_id) "
                           f"SORTED BY (session_id, turn) INTO {CHAT_BUCKETS} BUCKETS LOCATION '{path}'")
        return name

    def _read(self, parts: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*parts)

    def _source(self, name: str, files: list[list]) -> DataFrame:
        """Some files of a source table."""
        if not files:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(*[path for path, _, _ in files])

    def _one_more(self, known: dict, df: DataFrame, name: str) -> tuple[list[str], list[str], str]:
        fresh = self._write(df, name)
        return known["parts"] + fresh, fresh, known["schema"]

    def _make_lines(self, inputs):
        return V.lines_from(self._source("lineitem", inputs["lineitem"]), self._source("orders", inputs["orders"]))

    def _extend_lines(self, inputs, added, known):
        new = V.lines_from(self._source("lineitem", added["lineitem"]), self._source("orders", inputs["orders"]))
        if added["orders"]:
            old = self._source("lineitem", known["inputs"]["lineitem"])
            new = new.unionByName(V.lines_from(old, self._source("orders", added["orders"])))
        return self._one_more(known, new, "lines")

    def _make_sales(self, inputs):
        return V.sales_sums(self.lines())

    def _extend_sales(self, inputs, added, known):
        """Only the months that the new lines touch are read and written."""
        sums = V.sales_sums(self._read(added["lines"], self._entry("lines")["schema"]))
        # one row for each month of the calendar at most
        months = {f"month={r[0] or NO_MONTH}" for r in sums.select("month").distinct().collect()}
        touched = [p for p in known["parts"] if p.rsplit("/", 1)[1] in months]
        if touched:
            sums = V.merged_sums(sums.drop("month").unionByName(self._read(touched, known["schema"])))
        fresh = self._write(sums, "sales", months=True) if months else []
        return [p for p in known["parts"] if p not in touched] + fresh, fresh, known["schema"]

    def _make_promotions(self, inputs):
        return V.promotions_from(self.lines())

    def _make_market_share(self, inputs):
        return V.market_share_from(self.lines(), self.products())

    def _documents(self, files):
        return V.documents_from(self._source("documents", files))

    def _make_documents(self, inputs):
        return self._documents(inputs["documents"])

    def _extend_documents(self, inputs, added, known):
        return self._one_more(known, self._documents(added["documents"]), "documents")

    def _make_doc_index(self, inputs):
        from shelfline.operators.text import block_index
        # collapsed white space separates terms as it did before, so the texts are read as they are
        return block_index(self._source("documents", inputs["documents"]), "text")

    def _make_doc_blocks(self, inputs):
        from shelfline.operators.text import posting_blocks
        return posting_blocks(self.doc_index())

    def _positions(self, files):
        from shelfline.operators.text import term_positions
        return term_positions(self._source("documents", files), "text")

    def _make_doc_positions(self, inputs):
        return self._positions(inputs["documents"])

    def _extend_doc_positions(self, inputs, added, known):
        return self._one_more(known, self._positions(added["documents"]), "doc_positions")

    def _make_pivots(self, inputs):
        from shelfline.operators.retrieval import choose_pivots
        found = choose_pivots(V.vectors_from(self._source("embeddings", inputs["embeddings"])))
        return self.spark.createDataFrame(list(enumerate(found)), "n int, pivot array<double>")

    def _extend_pivots(self, inputs, added, known):
        """Pivots stay as they are, so stored distances hold."""
        return known["parts"], [], known["schema"]

    def pivots(self) -> list[list[float]]:
        """The pivots (a few vectors) of the stored distances."""
        return [r["pivot"] for r in self._table("pivots").orderBy("n").collect()]

    def _vectors(self, files):
        from shelfline.operators.retrieval import pivot_distances
        normed = V.vectors_from(self._source("embeddings", files)).withColumn("norm", VX.norm("embedding"))
        return normed.withColumn("pivot_distances", pivot_distances(self.pivots()))

    def _make_vectors(self, inputs):
        return self._vectors(inputs["embeddings"])

    def _extend_vectors(self, inputs, added, known):
        return self._one_more(known, self._vectors(added["embeddings"]), "vectors")

    def _make_store_sketches(self, inputs):
        from shelfline.operators.share import store_sketches
        return store_sketches(self.lines())

    def _extend_store_sketches(self, inputs, added, known):
        """Sketches merge when they are read, so those of the new lines are one more part."""
        from shelfline.operators.share import store_sketches
        return self._one_more(known, store_sketches(self._read(added["lines"], self._entry("lines")["schema"])), "store_sketches")

    def _memory_log(self, files):
        from shelfline.operators.memory import parsed
        return parsed(V.memory_log_from(self._source("events", files)))

    def _make_memory_log(self, inputs):
        return self._memory_log(inputs["events"])

    def _extend_memory_log(self, inputs, added, known):
        return self._one_more(known, self._memory_log(added["events"]), "memory_log")

    def _make_chat(self, inputs):
        return V.chat_from(self._source("conversations", inputs["conversations"]))

    # ---- scans

    def _table(self, name: str) -> DataFrame:
        entry = self._entry(name)
        return self._read(entry["parts"], entry["schema"])

    def max_of(self, table: str, col: str) -> dt.date | int | None:
        """MAX(col) as the manifest records it (None: the table is empty)."""
        if GREATEST.get(table) != col:
            raise ValueError(f"no maximum of {table}.{col} is recorded")
        value = self._entry(table)["greatest"]
        return dt.date.fromisoformat(value) if isinstance(value, str) else value

    def lines(self) -> DataFrame:
        return self._table("lines")

    def sales(self) -> DataFrame:
        """The weekly sales fact: a projection of the stored sums."""
        return V.sales_of(self._table("sales"))

    def promotions(self) -> DataFrame:
        return self._table("promotions")

    def market_share(self) -> DataFrame:
        return self._table("market_share")

    def documents(self) -> DataFrame:
        """Documents with whitespace-collapsed content, each file ordered by id."""
        return self._table("documents")

    def doc_index(self) -> DataFrame:
        """Inverted term index ``(doc_id, term, tf, block)`` of the documents."""
        return self._table("doc_index")

    def indexed_documents(self) -> DataFrame:
        """The source's documents that the term index was made from."""
        return self._source("documents", self._entry("doc_index")["inputs"]["documents"])

    def doc_blocks(self) -> DataFrame:
        """The index's posting blocks ``(term, block, max_tf, n)``."""
        return self._table("doc_blocks")

    def doc_positions(self) -> DataFrame:
        """Positional index ``(doc_id, pos, term, following)`` of the documents."""
        return self._table("doc_positions")

    def vectors(self) -> DataFrame:
        """Document vectors with their norm and distances to the pivots, computed once."""
        return self._table("vectors")

    def store_sketches(self) -> DataFrame:
        """Sketches of the accounts that sold a product in a month."""
        return self._table("store_sketches")

    def memory_log(self) -> DataFrame:
        """The memory log with its values parsed (VARIANT)."""
        return self._table("memory_log")

    def chat(self) -> DataFrame:
        """The chat, bucketed by session and sorted by turn: a filter on one session
        reads one bucket."""
        entry = self._entry("chat")
        return self.spark.table(self._bucketed(entry["parts"][0], entry["schema"]))

    def products(self) -> DataFrame:
        return V.products(self.spark, self.sf)

    def retailers(self) -> DataFrame:
        return V.retailers(self.spark, self.sf)
