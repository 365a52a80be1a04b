"""Labels, hashes and path classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_split(path: Column) -> Column:
    """train / eval / unknown from the text of a path; 'train' is tested first."""
    p = F.lower(path)
    return (
        F.when(p.contains("train"), "train")
        .when(p.contains("eval") | p.contains("test"), "eval")
        .otherwise("unknown")
    )


def label(prefix: str, ident: Column) -> Column:
    return F.concat(F.lit(prefix + " "), ident.cast("string"))


def record_hash(*cols: Column) -> Column:
    """md5 of the key fields joined by a pipe; a NULL field hashes as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def hash_uniform(*parts) -> Column:
    """A repeatable draw in [0, 1) from the first 32 bits of an md5."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
