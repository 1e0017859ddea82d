"""Quality rules as a ledger of failure bits, and policies that read it.

Every rule is evaluated once per document. The ledger stores what was measured and one bit
per failed rule; a policy is a versioned mask of rules, and trying another one, or asking
what a single rule costs, reads the bits and never the texts.

Only DataFrame functions are used. Documents are judged one row at a time, without a
shuffle; windows of words are compared through 64-bit hashes within their own document.

Results for special inputs: a null text has no words, lines or symbols; all measures are then
0 and the base rule fails; rows with equal ids are judged separately; an empty table gives no
rows; other columns of the table are not read.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from spendgrid.llm.store import column_named

WINDOW_WORDS = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_echo_words"]

# Each rule fails where its condition holds; its bit is its place in this list.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 40 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    ("shouting", "100 * n_upper > 35 * word_chars"),
    ("exclamation", "100 * n_marks > 50 * n_words"),
    ("echoed_words", "100 * n_echo_words > 30 * n_words"),
    ("word_length", "word_chars > 30 * n_words"),
]
BASE = ["few_words", "repeated_windows"]


@dataclass(frozen=True)
class Policy:
    """A named version of the rules that reject a document."""

    version: str
    rules: tuple

    @property
    def mask(self):
        names = [name for name, _ in RULES]
        return sum(1 << names.index(rule) for rule in self.rules)


POLICIES = {
    "v1": Policy("v1", tuple(BASE)),
    "v2": Policy("v2", tuple(name for name, _ in RULES)),
}


def _pieces(text, pattern):
    """How many characters of the class the text has."""
    return F.size(F.split(text, pattern)) - 1


def measure(docs, id_col="doc_id", text_col="text", keep=None):
    """doc_id and the measures of every whole text; `keep` is a column to return in place of doc_id.

    word_chars: code points in words. n_dup_lines: lines with a word that equal an earlier
    line. n_repeat_words: words in 8-word windows that occur twice or more in the text.
    n_echo_words: words equal to the word before.
    """
    own = column_named(id_col).alias("doc_id") if keep is None else keep
    rows = docs.select(own, F.coalesce(column_named(text_col).cast("string"), F.lit("")).alias("text"))
    own = rows.columns[0]
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # One element of an array of one: a lambda's variable is evaluated once, where a
    # column used inside a lambda would be computed again for every element.
    bind = lambda column, f: F.element_at(F.transform(F.array(column), f), 1)
    windows = lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (WINDOW_WORDS - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, WINDOW_WORDS))
    )
    echoes = lambda w: F.size(F.filter(F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: a == b), lambda same: same))
    return rows.select(
        own,
        bind(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                F.when(F.size(w) > WINDOW_WORDS, bind(windows(w), _repeat_words)).otherwise(0).cast("long").alias("n_repeat_words"),
                echoes(w).cast("long").alias("n_echo_words"),
            ),
        ).alias("w"),
        _pieces(F.col("text"), r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        _pieces(F.col("text"), r"\p{Lu}").cast("long").alias("n_upper"),
        _pieces(F.col("text"), "!").cast("long").alias("n_marks"),
        bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    ).select(own, *(F.col({"n_words": "w.", "word_chars": "w.", "n_repeat_words": "w.", "n_echo_words": "w.", "n_lines": "l.", "n_dup_lines": "l."}.get(m, "") + m).alias(m) for m in MEASURES))


def _repeat_words(hashes):
    """Words covered by windows whose hash occurs more than once; most texts have none and stop early."""

    def covered(starts):
        step = lambda acc, at: F.struct((acc["n"] + F.least(F.lit(WINDOW_WORDS), at - acc["last"])).alias("n"), at.alias("last"))
        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW_WORDS).alias("last")), step, lambda acc: acc["n"])

    def starts(ordered):
        pairs = F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), lambda a, b: F.when(a["hash"] == b["hash"], F.array(a["at"], b["at"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

    bind = lambda column, f: F.element_at(F.transform(F.array(column), f), 1)
    ordered = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(bind(ordered, starts))).otherwise(0)


def ledger(docs, id_col="doc_id", text_col="text"):
    """The measures and `bits`, in which every failed rule has its bit set."""
    return measure(docs, id_col, text_col).withColumn("bits", _bits())


def _bits():
    bits = None
    for place, (_, condition) in enumerate(RULES):
        bit = F.when(F.expr(condition), F.lit(1 << place)).otherwise(0).cast("long")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return bits


def kept(policy):
    """Whether a ledger row passes the policy."""
    return F.col("bits").bitwiseAND(F.lit(policy.mask)) == 0


def passing(docs, policy=POLICIES["v2"], id_col="doc_id", text_col="text"):
    """The documents that the policy keeps, with the columns of docs."""
    whole = F.struct(*map(column_named, docs.columns)).alias("whole")
    return measure(docs, id_col, text_col, whole).withColumn("bits", _bits()).where(kept(policy)).select("whole.*")


def ablations(ledger_rows, policies=tuple(POLICIES.values())):
    """Per policy and rule: documents that fail it, and those it alone rejects.

    The ledger is first counted by bit pattern, of which there are at most 2 to the number
    of rules, so only patterns are compared with the policies.
    """
    patterns = ledger_rows.groupBy("bits").agg(F.count("*").alias("n"))
    rows = [(p.version, p.mask, rule, 1 << place) for p in policies for place, (rule, _) in enumerate(RULES) if rule in p.rules]
    tries = F.array(*(F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(r).alias("rule"), F.lit(b).cast("long").alias("bit")) for v, m, r, b in rows))
    failed = F.col("bits").bitwiseAND(F.col("t.mask"))
    return (
        patterns.select("bits", "n", F.explode(tries).alias("t"))
        .groupBy("t.policy", "t.rule")
        .agg(
            F.sum(F.when(failed.bitwiseAND(F.col("t.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(failed == F.col("t.bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
            F.sum(F.when(failed == 0, F.col("n")).otherwise(0)).alias("kept"),
            F.sum("n").alias("documents"),
        )
    )
