"""Language identification by compression: a zstandard dictionary of raw text for each language.

A text is lower-cased, runs of other characters than letters become one space, and it is cut into blocks of BLOCK bytes
(whole, never a prefix); every block is compressed with each language's
dictionary, and the language whose sum is smallest wins, ties going to the least name by code point. A dictionary
holds at most DICTIONARY bytes: pieces of training texts from hashed positions, one for each of SAMPLES groups of ids, the
least by hash, each with an equal share of the bytes.
The score is a logistic share of the winner against the next, from their difference in bits a byte; where it is
narrow (under MARGIN bits a byte) ``rejected`` is true, while lang_pred keeps the nearest language.

Cases: null texts and texts without a letter are ``und`` with score 0; so are all texts if nothing was learned. Null
languages are not learned. Repeated rows give repeated rows; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, crc_mod

BLOCK, DICTIONARY, SAMPLES, PIECE, LEVEL, MARGIN = 1024, 64 << 10, 256, 400, 9, 0.02

_OTHERS = re.compile(r"[\W\d_]+")


def dictionaries(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Raw content for each language: at most SAMPLES pieces of texts, each cut to an equal share."""
    order = F.xxhash64("doc_id", text_col)
    group = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SAMPLES))
    at = (F.pmod(F.xxhash64("doc_id", text_col, F.lit(2)), F.greatest(F.length(text_col) - PIECE + 1, F.lit(1))) + 1).cast("int")
    some = training.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(lang_col).alias("lang"), group.alias("g"), order.alias("o"), F.substring(F.col(text_col), at, F.lit(PIECE)).alias("t"))
    found: dict[str, list] = {}
    for r in some.groupBy("lang", "g").agg(F.min_by("t", F.struct("o", "t")).alias("t")).orderBy("lang", "g").toLocalIterator():
        found.setdefault(r.lang, []).append(r.t)
    return {k: b"".join(letters(t)[: DICTIONARY // len(v)] for t in v) for k, v in found.items()}


def letters(text: str) -> bytes:
    return (" " + _OTHERS.sub(" ", text.lower())).encode()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(docs: DataFrame, raw: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected)."""
    arrow_limits(docs.sparkSession)
    names = sorted(raw, key=lambda x: x.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = []
        for name in names:
            content = zstandard.ZstdCompressionDict(raw[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False))
        for batch in batches:
            langs, scores, narrow = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                if not text or not coders or not has_letter(text):
                    langs.append("und")
                    scores.append(0.0)
                    narrow.append(True)
                    continue
                data = letters(text)
                blocks = [data[j : j + BLOCK] for j in range(0, len(data), BLOCK)]
                cost = np.array([sum(len(c.compress(b)) for b in blocks) for c in coders])
                best = int(cost.argmin())
                gap = (np.delete(cost, best).min() - cost[best]) * 8 / len(data) if len(cost) > 1 else 1.0
                langs.append(names[best])
                scores.append(round(float(1 / (1 + np.exp(-8 * gap))), 6))
                narrow.append(bool(gap < MARGIN))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(narrow, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """predict() of all docs, learning from those whose crc32(doc_id as text) mod 4 is not 2, with held_out (it is 2)."""
    raw = dictionaries(docs.where(crc_mod("doc_id", 4) != 2))
    return predict(docs, raw).withColumn("held_out", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)))
