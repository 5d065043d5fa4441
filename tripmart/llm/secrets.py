"""Secret scan over an incremental ledger of blobs.

Every text is addressed by the SHA-256 of its content. The ledger holds one
row per (blob, rule version) already scanned with the spans found, also when
there are none. A run scans only pairs that the ledger lacks, once per blob
however many paths carry it, appends them, and joins the findings back to all
paths. A new rule version scans everything again and leaves old rows alone.

Defined results: a null text is an empty blob without spans; a null id is a
path like any other; repeated rows give repeated rows; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import small_side, stored

#: Change with any change of the rules below.
RULES = "2024-06-2"

# Kinds in the order in which equal starts are listed; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "pem", "jwt")
BASE = 3

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# A key lasts to the next end line. Without one before the next key it lasts over its header fields and
# all that is base64: long runs, what stands alone on a line, and a last run of whole groups of four.
_PEM = re.compile(
    r"""-----BEGIN\x20[A-Z ]{0,40}PRIVATE\x20KEY-----
    (?: (?:(?!-----BEGIN\x20).)*? -----END\x20[A-Z ]{0,40}PRIVATE\x20KEY-----
    | (?:GAP (?:Proc-Type|DEK-Info|Version|Comment):[^\r\n\\]*)*
      (?:GAP (?:[A-Za-z0-9+/]{16,}={0,2} | [A-Za-z0-9+/]+={0,2}(?=[\x20\t"',]*(?:\\[nr]|[\r\n\\]|\Z))))*
      (?:(?<=[A-Za-z0-9+/]{16})GAP (?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{4}|[A-Za-z0-9+/]{3}=|[A-Za-z0-9+/]{2}==)(?![A-Za-z0-9+/=]))?
    )""".replace("GAP", r"""(?:\s|\\[nrt]|\\(?=\s)|["'>\#|,])*"""),
    re.VERBOSE | re.DOTALL,
)
# What follows a run of token characters is looked at once for the run, not again for every eyJ in it.
_JWT = re.compile(
    r"""(?<!RUN)(?=RUN++\.eyJ RUN{10,}+\.RUN{10}) RUN*?
    (eyJ RUN{10,}+\.eyJ RUN{10,}+\.RUN{10,}+)""".replace("RUN", "[A-Za-z0-9_-]"),
    re.VERBOSE,
)

_FOUND = "blob binary, kinds array<int>, starts array<int>, ends array<int>"
_LEDGER = _FOUND + ", rules string"


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every span of a text in code points, sorted."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        # A short value still consumes its text, so it is dropped after the match.
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "-----BEGIN" in text:
        out += [(m.start(), 3, m.end()) for m in _PEM.finditer(text)]
    if "eyJ" in text:
        out += [(m.start(1), 4, m.end(1)) for m in _JWT.finditer(text)]
    return sorted(out)


def _scan(batches):
    for batch in batches:
        columns: list[list[list[int]]] = [[], [], []]
        for text in batch.column("text"):
            found = spans_of(text.as_py() or "")
            for column, i in zip(columns, (1, 0, 2)):
                column.append([span[i] for span in found])
        lists = [pa.array(c, pa.list_(pa.int32())) for c in columns]
        yield pa.RecordBatch.from_arrays([batch.column("blob"), *lists], ["blob", "kinds", "starts", "ends"])


def _ledger(spark, path: str | None) -> DataFrame:
    """Rows of the ledger; a folder that does not exist yet is an empty ledger."""
    if path is not None:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return spark.read.schema(_LEDGER).parquet(path)
    return spark.createDataFrame([], _LEDGER)


def _known(spark, path: str | None, rules: str) -> DataFrame:
    """One row of each blob scanned with these rules; retries and second writers may have added more."""
    return _ledger(spark, path).where(F.col("rules") == rules).dropDuplicates(["blob"])


def scan_secrets(docs: DataFrame, ledger: str | None = None, rules: str = RULES) -> DataFrame:
    """doc_id, blob (hex), kinds, starts and ends of the spans of every row of ``docs``.

    ``ledger`` is a folder on shared storage, grown by each run; without one the
    run keeps its own. Rows of ``docs`` are versions: pass every historical
    version, with ``doc_id`` as its path.
    """
    spark = docs.sparkSession
    addressed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("blob", F.unhex(F.sha2("text", 256)))
    paths = stored(addressed.select("doc_id", "blob"), "secrets-paths")
    # One path of each blob, taken within map tasks first, is read again for its text if the blob is unseen.
    chosen = paths.groupBy("blob").agg(F.min("doc_id").alias("chosen"))
    chosen = chosen.join(_known(spark, ledger, rules).select("blob"), "blob", "left_anti")
    texts = addressed.join(
        chosen, (addressed.blob == chosen.blob) & addressed.doc_id.eqNullSafe(chosen.chosen), "left_semi"
    )
    found = texts.select("blob", "text").mapInArrow(_scan, _FOUND).dropDuplicates(["blob"])
    found = found.withColumn("rules", F.lit(rules))
    if ledger is None:
        known = stored(found, "secrets-ledger")
    else:
        found.write.mode("append").parquet(ledger)
        known = _known(spark, ledger, rules)
    return paths.join(known.drop("rules"), "blob").select("doc_id", F.hex("blob").alias("blob"), "kinds", "starts", "ends")


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of base spans and the text of all spans."""
    names = F.array(*[F.lit(k) for k in KINDS])
    span = F.arrays_zip("kinds", "starts", "ends")

    def written(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.get(names, s["kinds"]), s["starts"].cast("string"), s["ends"].cast("string")
                ),
            ),
            ",",
        )

    def number(kind: int):
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [number(kind) for kind in range(BASE)]
    base = F.filter(span, lambda s: s["kinds"] < BASE)
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(span).alias("spans"), "blob"
    )


REDACTED = "[REDACTED]"


def _redact(starts_name: str, ends_name: str):
    def run(batches):
        for batch in batches:
            texts = []
            for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("text", starts_name, ends_name))):
                if starts:
                    out, at = [], 0
                    for start, end in zip(starts, ends):
                        if start >= at:
                            out += [text[at:start], REDACTED]
                        # A span inside the one before adds nothing, an overlapping one its rest.
                        at = max(at, end)
                    text = "".join([*out, text[at:]])
                texts.append(text)
            names = [n for n in batch.schema.names if n not in (starts_name, ends_name)]
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def redact_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` with all spans found replaced in ``text``; all rows and columns stay, whatever their names."""
    taken, mark = {c.lower() for c in docs.columns}, "_"
    while taken & {name + mark for name in ("blob", "starts", "ends")}:
        mark += "_"
    blob, starts, ends = "blob" + mark, "starts" + mark, "ends" + mark
    found = scan_secrets(docs, ledger).where(F.size("kinds") > 0)
    # By content: equal texts have equal spans, also under null or repeated ids.
    spans = found.select(F.lower("blob").alias(blob), F.col("starts").alias(starts), F.col("ends").alias(ends))
    spans = small_side(stored(spans.dropDuplicates([blob]), "secrets-spans"))
    content = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    rows = docs.withColumn(blob, content).join(spans, blob, "left")
    return rows.select(*docs.columns, starts, ends).mapInArrow(_redact(starts, ends), docs.schema)
