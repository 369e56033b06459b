"""SentencePiece encoding and decoding with byte spans into the original text.

The normaliser is applied here, by longest-prefix look-up in the model's compiled character map, and records
for every normalised byte the source byte it came from. The library's own merges give the ids of the normalised
text; adding up the pieces' lengths and going back through the record gives each piece's span in the source.

Defined results: null text is taken as empty; empty text has no pieces beyond begin and end; other columns are
carried along untouched; any length is encoded whole. Decoding a null list gives null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattline.llm.common import map_texts
from wattline.llm.pieces import codec, read_model


def encode(df: DataFrame, model_path: str, text: str = "text", spans: bool = False, check: bool = False) -> DataFrame:
    """All other columns, and ``ids`` with begin and end. ``spans`` adds ``starts`` and ``ends``: byte spans in the
    source (empty for begin and end); ``check`` adds ``decoded_equal``: whether decoding gives the source again."""
    model = read_model(model_path)
    schema = "ids array<int>" + ", starts array<int>, ends array<int>" * spans + ", decoded_equal boolean" * check

    def make(texts):
        own, texts = codec(model), [t or "" for t in texts]
        lists = own.encode_ids(texts)
        out = {"ids": lists}
        if spans:
            found = [own.align(t, ids) for t, ids in zip(texts, lists, strict=True)]
            out |= {"starts": [e.starts for e in found], "ends": [e.ends for e in found]}
        if check:
            decoded = own.lib.decode([x.tolist() for x in lists])
            out["decoded_equal"] = [a == b for a, b in zip(decoded, texts, strict=True)]
        return out

    rest = [c for c in df.columns if c not in (text, "ids", "starts", "ends", "decoded_equal")]
    return map_texts(df, text, schema, make, rest)


def decode(df: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """All columns, with ``decoded`` as the library decodes the ids; null ids decode to null."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructField, StringType, StructType

    model = read_model(model_path)
    df = df.drop("decoded")
    schema = StructType([*df.schema.fields, StructField("decoded", StringType())])

    def run(batches):
        lib = codec(model).lib
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = [None if x is None else lib.decode(x) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return df.select(*[F.col(f"`{c}`") for c in df.columns]).mapInArrow(run, schema)


def encode_digests(df: DataFrame, model_path: str, key: list[str], text: str = "text") -> DataFrame:
    """Round trip of every text in one pass, as digests, for when the ids themselves aren't to be moved.

    ``n_tokens``, ``ids_sha256``, ``decoded_sha256``; ``n_bytes`` of the source, ``spans_sha256`` (all starts, then all ends,
    as little-endian unsigned 32-bit integers) and ``spans_cover``: whether the spans follow each other and cover the source
    from its first byte to its last.
    """
    model = read_model(model_path)

    def make(texts):
        own = codec(model)
        texts = [t or "" for t in texts]
        lists = own.encode_ids(texts)
        out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "n_bytes": [], "spans_cover": [], "spans_sha256": []}
        for source, ids, decoded in zip(texts, lists, own.lib.decode([x.tolist() for x in lists]), strict=True):
            e = own.align(source, ids)
            size = len(source.encode())
            cover = e.starts[0] == 0 and e.ends[-1] == size and bool((e.starts[1:] == e.ends[:-1]).all())
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            out["n_bytes"].append(size)
            out["spans_cover"].append(bool(cover))
            out["spans_sha256"].append(hashlib.sha256(np.stack((e.starts, e.ends)).astype("<u4").tobytes()).hexdigest())
        return out

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint, spans_cover boolean, spans_sha256 string"
    return map_texts(df, text, schema, make, key)
