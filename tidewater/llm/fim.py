"""Fill-in-the-middle: a text cut at two of its token bounds, and its middle moved to the end.

Built from string functions only.  A delimiter is escaped in the text, then put
behind every token by one regexp_replace; counting it counts the tokens, and
substring_index gives the tokens up to or from a rank.  Taking the delimiters out
and unescaping gives back the exact parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import unused

#: Put behind every token.
MARK = "\u0001"
#: Begins an escaped character: ESCAPE itself, or MARK.
ESCAPE, ESCAPED_ESCAPE, ESCAPED_MARK = "\u0002", "\u0002\u0003", "\u0002\u0004"
#: A token of the escaped text: a word of letters, an escaped character, any other character.
TOKEN = "[A-Za-z]+|\u0002[\u0003\u0004]|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _replaced(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    """``text`` without MARK in it."""
    return _replaced(_replaced(text, ESCAPE, ESCAPED_ESCAPE), MARK, ESCAPED_MARK)


def unescaped(marked: Column) -> Column:
    """The text of which ``marked`` is the escaped form, with or without delimiters."""
    return _replaced(_replaced(_replaced(marked, MARK, ""), ESCAPED_MARK, MARK), ESCAPED_ESCAPE, ESCAPE)


def hash_group(key: Column, nth: int) -> Column:
    """The ``nth`` (from 1) group of eight hexadecimal digits of ``key``'s SHA-256, as a number."""
    return F.conv(F.substring(F.sha2(key, 256), 8 * nth - 7, 8), 16, 10).cast("long")


def restored(output: Column, form: Column) -> Column:
    """The text from which fill_in_middle() made ``output`` in ``form``; a marker occurs once in an output that isn't plain."""
    cut = lambda text, mark, n: F.substring_index(text, mark, n)
    middle = cut(output, MIDDLE, -1)
    front = cut(output, MIDDLE, 1)
    psm = F.concat(cut(cut(front, SUFFIX, 1), PREFIX, -1), middle, cut(front, SUFFIX, -1))
    spm = F.concat(cut(front, PREFIX, -1), middle, cut(cut(front, PREFIX, 1), SUFFIX, -1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "1", apart: int = 90, spm: int = 20) -> DataFrame:
    """``docs`` with n_tokens, form, prefix, middle, suffix and output of every text.

    The hash of ``seed``, a colon and the key decides where the text is cut: after
    so many tokens (words of A-Z and a-z, and every other character), either end
    included.  ``form`` is psm (``<P>`` prefix ``<S>`` suffix ``<M>`` middle), in
    ``spm`` of 100 cases spm (``<S>`` suffix ``<P>`` prefix ``<M>`` middle), and
    plain, with the text as it is and null parts, for the rest from ``apart`` of
    100 on and for texts that are empty or contain a marker.

    A null text is an empty one; a row without a key is hashed with an empty key,
    and repeated rows give repeated results.  Texts are worked on whole, however
    long, and may hold any character, the delimiter and the escape too.  Other
    columns stay; of those that are called like a new one only the new one is
    left.  An empty table gives an empty one.
    """
    new = ("n_tokens", "form", "prefix", "middle", "suffix", "output")
    have = {c.lower(): c for c in docs.columns}
    key, text = have[key.lower()], have[text.lower()]
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    whole, marked, cuts, last = (unused([*docs.columns, *new], c) for c in ("whole", "marked", "cuts", "last"))
    helpers = [F.col(c) for c in (whole, marked, cuts)]
    hashed = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    out = docs.select(*kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(whole), F.array(*[hash_group(hashed, i) for i in range(1, 5)]).alias(cuts))
    out = out.withColumn(marked, F.regexp_replace(escaped(F.col(whole)), f"({TOKEN})", f"$1{MARK}"))
    out = out.withColumn("n_tokens", (F.octet_length(marked) - F.octet_length(_replaced(F.col(marked), MARK, ""))).cast("long"))
    a, b = (F.col(cuts)[i] % (F.col("n_tokens") + 1) for i in range(2))
    has_marker = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        has_marker |= F.contains(F.col(whole), F.lit(marker))
    form = F.when((F.col(whole) == "") | has_marker | (F.col(cuts)[2] % 100 >= apart), "plain").when(F.col(cuts)[3] % 100 < spm, "spm").otherwise("psm")
    # the first `a` tokens, those up to the `b`th, and those behind it, as Spark counts delimiters with ints
    out = out.select(*kept, *helpers, "n_tokens", F.least(a, b).cast("int").alias("prefix"), F.greatest(a, b).cast("int").alias(last), form.alias("form"))
    cut = out["form"] != "plain"
    index = lambda of, n: F.call_function("substring_index", of, F.lit(MARK), n)
    front = index(F.col(marked), F.col(last))
    middle = F.when(F.col("prefix") == 0, front).otherwise(index(front, F.col("prefix") - F.col(last)))
    suffix = index(F.col(marked), F.col(last) - F.col("n_tokens").cast("int") - 1)
    part = lambda of: F.when(cut, unescaped(of))
    out = out.select(*kept, whole, "n_tokens", "form", part(index(F.col(marked), F.col("prefix"))).alias("prefix"), part(middle).alias("middle"), part(suffix).alias("suffix"))
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm_form = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    return out.select(*kept, "n_tokens", "form", "prefix", "middle", "suffix", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm_form).otherwise(F.col(whole)).alias("output"))
