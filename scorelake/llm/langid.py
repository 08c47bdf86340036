"""Language identification by compression.

Each language gets a raw-content zstandard dictionary made of text slices of a
bounded, hash-chosen sample of its training documents. A text is cut into
chunks; every chunk is compressed with every dictionary, and the language with
the smallest total wins. The score is the relative margin to the second; a
margin under ``MIN_MARGIN`` marks the row as rejected.

Defined results: a null text, or one without letters, is ``und`` with score 0;
with a single language its score is 1; without any training row all are
``und``. Only ``lang`` and ``text`` of the training rows are learned from;
prediction reads the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_batches

#: The bounds of the fit: slices per language and characters per slice.
SLICES, SLICE_CHARS = 160, 700
#: Languages that a fit takes (a dictionary of up to 112 KB each goes to every task); more raise an error.
MOST_LANGUAGES = 400
CHUNK_BYTES = 4096
LEVEL = 3
MIN_MARGIN = 0.02
UNKNOWN = "und"
_LETTERS = regex.compile(r"(?:\p{L}\p{M}*)+")


def letters(text: str | None) -> bytes:
    """The normal form: lower case, each run of non-letters one space (a mark after a letter belongs to it)."""
    return " ".join(_LETTERS.findall((text or "").lower())).encode("utf-8", "replace")


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text",
          key: Column | None = None) -> dict[str, bytes]:
    """Per language the dictionary bytes, from at most ``SLICES`` slices of its documents.

    Rows are chosen by the rank of a hash of ``key`` (the text by default); a
    count per language first gives the hash bound that about twice as many
    rows pass, so no language is sorted or gathered whole.
    """
    text, lang = F.col(text_col), F.col(lang_col)
    rows = df.where(lang.isNotNull() & text.isNotNull()).select(
        lang.alias("lang"), text.alias("text"),
        F.xxhash64(F.lit("slice"), text if key is None else key).alias("h"))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 2 * SLICES / n))])
    uniform = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    # a slice from anywhere in the text, by another part of the hash
    start = 1 + F.pmod(F.shiftright("h", 31), F.greatest(F.lit(1), F.length("text") - SLICE_CHARS + 1))
    taken = (rows.where(uniform < share[F.col("lang")])
             .select("lang", "h", F.substring(F.col("text"), start.cast("int"), F.lit(SLICE_CHARS)).alias("s"))
             .collect())
    out = {}
    for lang_name in sorted(sizes):
        mine = sorted((r["h"], r["s"]) for r in taken if r["lang"] == lang_name)[:SLICES]
        out[lang_name] = b" ".join(letters(s) for _, s in mine)
    return {k: v for k, v in out.items() if v}


class Scorer:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.codecs = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.codecs.append(zstandard.ZstdCompressor(
                dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float]:
        data = letters(text)
        if not data or not self.names:
            return UNKNOWN, 0.0
        chunks = [data[i:i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
        size = np.array([sum(len(c.compress(x)) for x in chunks) for c in self.codecs])
        order = np.argsort(size, kind="stable")
        if len(order) == 1:
            return self.names[0], 1.0
        best, second = size[order[:2]]
        return self.names[order[0]], float(second - best) / float(second)


def predict(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id",
            text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the ``carry`` columns, lang_pred, score and rejected (narrow margin)."""
    src = df.select(F.col(id_col).alias("doc_id"), *carry, F.col(text_col).cast("string").alias("__text"))
    names = [f.name for f in src.schema][:-1]
    sent = df.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batch: pa.RecordBatch, scorer: Scorer) -> pa.RecordBatch:
        found = [scorer(t) for t in batch.column(len(names)).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64()),
             pa.array([f[0] == UNKNOWN or f[1] < MIN_MARGIN for f in found], pa.bool_())],
            [*names, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return map_batches(src, run, f"{schema}, lang_pred string, score double, rejected boolean",
                       state=lambda: Scorer(sent.value))
