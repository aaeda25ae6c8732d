"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps one failure bit per
rule and the measurements behind it.  Versioned policies are masks over those
bits, so a policy change or an ablation never reads the texts again.

Edge cases: null text counts as an empty text (no words, every measurement 0,
rule ``few_words`` fails); repeated rows give repeated ledger rows; an empty
table gives an empty ledger; columns other than ``doc_id`` and ``text`` are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAKS, id_as_text, id_restored

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rule name -> (bit, SQL condition under which the rule fails), over the measurements.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 10"),
    "repeated_windows": (1, "100 * n_repeat_words > 20 * n_words"),
    "symbols": (2, "10 * n_symbols > 3 * n_words AND n_words > 0"),
    "repeated_lines": (3, "2 * n_dup_lines > n_lines"),
    "upper_case": (4, "2 * n_upper > n_letters AND n_letters >= 30"),
    "word_length": (5, "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words)"),
    "few_letters": (6, "2 * n_letters < word_chars AND word_chars > 0"),
    "exclamations": (7, "2 * n_exclamations > n_words AND n_words > 0"),
}
BASE = ("few_words", "repeated_windows")
#: Versioned policies: a document is kept if none of the policy's rules fails.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": BASE,
    "full-1": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_exclamations")


def policy_mask(policy: str) -> int:
    return sum(1 << RULES[r][0] for r in POLICIES[policy])


def repeated_window_words(words: list) -> int:
    """Words inside WINDOW-word windows that occur twice or more in the list (exact: ids of pairs of ids, no hashing)."""
    if len(words) <= WINDOW:
        return 0
    first: dict = {}
    one = np.fromiter((first.setdefault(w, len(first)) for w in words), np.int64, len(words))
    if len(first) == len(words):
        return 0

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]

    two = joined(one[:-1], one[1:])
    four = joined(two[:-2], two[2:])
    five = joined(four[:-1], one[4:])
    again = np.flatnonzero(np.bincount(five)[five] > 1)
    if not len(again):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def measure(text: str | None) -> tuple:
    """The measurements of one whole text, in the order of MEASURES."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_blank = sum(map(text.count, WORD_BREAKS))
    lines = [x for x in text.split("\n") if x.strip(WORD_BREAKS)]
    ascii_only = text.isascii()
    if ascii_only:
        raw = np.frombuffer(text.encode(), np.uint8)
        upper = (raw >= 65) & (raw <= 90)
        n_upper = int(np.count_nonzero(upper))
        n_letters = n_upper + int(np.count_nonzero((raw >= 97) & (raw <= 122)))
    else:
        n_letters = sum(map(str.isalpha, text))
        n_upper = sum(map(str.isupper, text))
    return (
        len(words), len(text) - n_blank, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
        repeated_window_words(words), n_upper, n_letters, text.count("!"),
    )


def measurements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [measure(t) for t in batch["text"]]
        out = pd.DataFrame(rows, columns=list(MEASURES), dtype="int64") if rows else pd.DataFrame({m: pd.Series(dtype="int64") for m in MEASURES})
        out.insert(0, "doc_id", batch["doc_id"].values)
        yield out


def failure_bits(struct: str | None = None) -> Column:
    """The bitmask of failed rules, over the measurement columns or those of a struct."""
    return sum((F.when(F.expr(qualified(sql, struct) if struct else sql), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, sql in RULES.values()), F.lit(0)).cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, failures): one row per document; each rule is evaluated once."""
    measured = id_as_text(docs.select("doc_id", "text")).mapInPandas(measurements, "doc_id string, " + ", ".join(f"{m} long" for m in MEASURES))
    return id_restored(measured, docs).withColumn("failures", failure_bits())


def apply_policy(book: DataFrame, policy: str) -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return book.withColumn("kept", F.col("failures").bitwiseAND(F.lit(policy_mask(policy))) == 0)


def ablate(book: DataFrame, policy: str) -> DataFrame:
    """(rule, n_failed, n_only, n_kept_without): what each rule of the policy rejects, alone, and if it is dropped.

    One pass of conditional counts over the masks, so its size is the number of rules.
    """
    mask = policy_mask(policy)
    bits = {r: 1 << RULES[r][0] for r in POLICIES[policy]}
    held = F.col("failures").bitwiseAND(F.lit(mask))
    counts = [F.count_if(held == 0).alias("kept")]
    for rule, bit in bits.items():
        counts += [F.count_if(held.bitwiseAND(F.lit(bit)) != 0).alias(f"f_{rule}"), F.count_if(held == bit).alias(f"o_{rule}")]
    entries = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"), F.col(f"o_{r}").alias("n_only"), (F.col("kept") + F.col(f"o_{r}")).alias("n_kept_without")) for r in bits])
    return book.agg(*counts).select(F.inline(entries))


def filter_documents(docs: DataFrame, policy: str = "full-1") -> DataFrame:
    """The documents that the policy keeps, with the columns and rows of the input (repeated rows stay repeated)."""
    name = "_cx_measures"
    while name in docs.columns:
        name += "_"

    def one(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")

    measured = docs.withColumn(name, F.pandas_udf(one, ", ".join(f"{m} long" for m in MEASURES))(F.col("text")))
    kept = failure_bits(name).bitwiseAND(F.lit(policy_mask(policy))) == 0
    return measured.filter(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def qualified(sql: str, struct: str) -> str:
    for m in MEASURES:
        sql = re.sub(rf"\b{m}\b", f"`{struct}`.{m}", sql)
    return sql
