"""Operator 11, language identification by compression: a text is encoded with one zstandard raw-content dictionary for each language, and
the language whose dictionary gives the smallest code wins; narrow margins are rejected.

Fitting: labelled texts are lower-cased and cut into pieces of PIECE bytes; of each language's distinct pieces the PIECES with the
smallest hashes are its dictionary. So every labelled text takes part, copies count once, and the dictionary is a sample of at
most PIECES * PIECE bytes for each of at most MOST_LANGUAGES languages (more are an error): this bounds what the driver
gathers and each task holds. Encoding: a whole text goes in blocks of BLOCK bytes, each against the dictionary alone, so the end of a long text
weighs as much as its start and memory is bounded.

score is the share of the winner when each language counts 2 ** -(bits of its code). rejected tells that the runner-up's code is longer by
less than MARGIN_BYTES or by less than the share MARGIN.

Defined results: null texts and texts without a letter are `und` with score 0, not rejected; a null lang teaches nothing; without any
labelled text all are `und`; of equal codes the language with more labelled texts wins, then the first by name; a single learned
language always wins, with score 1; repeated rows give repeated rows; rows with a null doc_id have the empty text as id and so are not
held out; other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import tidied, utf8, with_columns_of

#: Bytes of a piece, pieces of a dictionary, languages of a model.
PIECE, PIECES, MOST_LANGUAGES = 1024, 100, 500
LEVEL, BLOCK = 6, 8192
#: What the runner-up's code must be longer by, in bytes and as a share of it.
MARGIN_BYTES, MARGIN = 2, 0.01
UNKNOWN = "und"


class Language(NamedTuple):
    name: str
    texts: int
    dictionary: bytes


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _pieces(limits: dict[str, int] | None):
    """(lang, hash, piece) of the pieces whose hash is under the language's limit; without limits the hashes of all, and whether each is a text's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                langs, hashes, held = [], [], []
                for lang, text in zip(part.column("lang").to_pylist(), utf8(part, "text"), strict=True):
                    for i in range(0, len(text), PIECE):
                        h = xxhash.xxh64_intdigest(text[i : i + PIECE]) >> 1
                        if limits is None or h < limits[lang]:
                            langs.append(lang)
                            hashes.append(h)
                            held.append(i == 0 if limits is None else text[i : i + PIECE])
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(held, pa.bool_() if limits is None else pa.binary())], ["lang", "h", "held"])

    return run


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[Language]:
    """A dictionary for each language of the labelled texts; rows without text or language are left out."""
    d = with_columns_of(labelled, text=text_col, lang=lang_col).where("lang is not null and text is not null")
    d = d.withColumns({"lang": F.col("lang").cast("string"), "text": F.lower("text")})
    counts = d.mapInArrow(tidied(_pieces(None)), "lang string, h long, held boolean").groupBy("lang").agg(F.approx_count_distinct("h").alias("pieces"), F.sum(F.col("held").cast("long")).alias("texts"))
    known = counts.limit(MOST_LANGUAGES + 1).collect()
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"language identification: more than {MOST_LANGUAGES} languages")
    if not known:
        return []
    # half as many again as are wanted, as the counts are estimates
    limits = {r.lang: min(1 << 63, int(1.5 * (PIECES + 16) / max(r.pieces, 1) * (1 << 63))) for r in known}
    drawn = d.mapInArrow(tidied(_pieces(limits)), "lang string, h long, held binary").groupBy("lang", "h").agg(F.min("held").alias("piece"))
    held: dict[str, list] = {r.lang: [] for r in known}
    for r in drawn.limit(3 * (PIECES + 16) * len(known)).collect():  # at most 348 kB a language
        held[r.lang].append((r.h, bytes(r.piece)))
    return [Language(r.lang, r.texts, b"".join(p for _, p in sorted(held[r.lang])[:PIECES])) for r in sorted(known, key=lambda r: r.lang)]


def _encoders(model: list[Language]) -> list[zstandard.ZstdCompressor]:
    out = []
    for language in model:
        d = zstandard.ZstdCompressionDict(language.dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False))
    return out


def code_sizes(text: bytes, encoders: list[zstandard.ZstdCompressor]) -> list[int]:
    """Bytes of the whole text's code with each dictionary."""
    blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
    return [sum(len(e.compress(b)) for b in blocks) for e in encoders]


def _classified(model: list[Language], id_type: pa.DataType):
    order = sorted(range(len(model)), key=lambda k: (-model[k].texts, model[k].name))

    def judge(text: bytes, encoders) -> tuple:
        size = code_sizes(text, encoders)
        first, *rest = sorted(order, key=lambda k: size[k])  # stable: ties as in order
        share = 1 / sum(2.0 ** -min(8 * (size[k] - size[first]), 1000) for k in range(len(size)))
        if not rest:
            return model[first].name, None, size[first], None, share, False
        gap = size[rest[0]] - size[first]
        return model[first].name, model[rest[0]].name, size[first], size[rest[0]], share, gap < max(MARGIN_BYTES, MARGIN * size[rest[0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(model)
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                got = [judge(t, encoders) if ok and model else (UNKNOWN, None, None, None, 0.0, False) for t, ok in zip(utf8(part, "text"), part.column("lettered").to_pylist(), strict=True)]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(id_type), *[pa.array([g[k] for g in got], t) for k, t in enumerate(kinds)]], ["doc_id", "best", "runner_up", "size", "runner_up_size", "score", "rejected"])

    return run


def classify(docs: DataFrame, model: list[Language], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, best, runner_up, size, runner_up_size, score, rejected) of each whole text."""
    from pyspark.sql.pandas.types import to_arrow_type

    d = with_columns_of(docs, doc_id=id_col, text=text_col)
    d = d.select("doc_id", F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    kind = d.schema["doc_id"].dataType
    return d.mapInArrow(tidied(_classified(model, to_arrow_type(kind))), f"doc_id {kind.simpleString()}, best string, runner_up string, size long, runner_up_size long, score double, rejected boolean")


def query(docs: DataFrame) -> DataFrame:
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    c = classify(docs, model)
    return c.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("best").alias("lang_pred"), "score", "runner_up", "size", "runner_up_size", "rejected")
