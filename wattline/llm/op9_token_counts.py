"""Token counts by whole-token shortcut.

Offline, once per model, two facts are proved over the vocabulary (``pieces.Pretokens``): where a text may be cut
because merges never cross, and which vocabulary strings alone encode to exactly one token. The pre-tokens of a text
among them count one each; only the rest is merged by the library, each distinct string once while it stays in a
bounded memory. Models for which no cut can be proved are refused.

Defined results: null text counts as empty; empty text has 0 tokens; any length is counted whole; repeated rows are
counted each; columns of the input that clash with the made ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattline.llm.common import map_texts
from wattline.llm.pieces import codec, read_model


def count_tokens(df: DataFrame, model_path: str, limit: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all other columns by default) with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``)."""
    model = read_model(model_path)

    def make(texts):
        cuts = codec(model).cuts
        if cuts is None:
            raise NotImplementedError("no cut is proved for this model")
        cut, whole = cuts.all([t or "" for t in texts]), cuts.whole
        n = []
        for units in cut:
            rest = [u for u in units if u not in whole]
            n.append(len(units) - len(rest) + sum(map(len, map(cuts.memory.__getitem__, rest))) // 4)
        return {"n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    made = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in df.columns if c != text and c not in made] if keep is None else keep
    return map_texts(df, text, "n_bytes bigint, n_tokens bigint, over_limit boolean", make, keep)
