"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, the posterior decides.

Each rule votes +1 (good), -1 (bad) or 0 (abstains). The prior and, for each rule, how often it votes bad on good and on
bad documents are estimated by expectation-maximisation over the table of vote patterns, which has at most 3^rules rows
however many documents there are; the iteration is one SQL aggregate() over that table. So one bad vote of a rule that
almost never errs on good documents outweighs many good votes of rules that let most bad ones pass, and no rule has a
veto by decree. Only DataFrame functions are used.

Cases: a null text has no words and fails the base rules; so do texts under ten words. Texts of any length are read
whole; repeated rows are judged alike. An empty table gives no rows. 5-word windows are compared by 64-bit hash. Nothing
but the id and the text is read, so other columns and their names do not matter; null ids stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import kept, words_of

#: rule: (value, good when at most, bad when over) as SQL over the columns of measures(); between them it abstains
RULES = {
    "symbols": ("n_symbols / greatest(n_words, 1)", 0.1, 0.3),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.1, 0.3),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.05, 0.2),
    "long_words": ("word_chars / greatest(n_words, 1)", 10.0, 14.0),
    "short": ("10 / greatest(n_words, 1)", 0.5, 1.0),
    "shouting": ("n_upper / greatest(word_chars, 1)", 0.2, 0.5),
    "exclaims": ("n_marks / greatest(n_words, 1)", 0.1, 0.3),
    "signs": ("n_signs / greatest(word_chars, 1)", 0.06, 0.11),
    "stutter": ("n_stutter / greatest(n_words, 1)", 0.02, 0.1),
}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 5) -> DataFrame:
    """id and the counts that rules look at, each row by itself."""
    t = F.col("t")
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    df = df.select("id", words_of(t).alias("w"), F.split(t, "\n").alias("lines"),
                   F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                   F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
                   F.length(F.regexp_replace(t, r"[^!?]+", "")).cast("long").alias("n_marks"), F.length(F.regexp_replace(t, r"[\p{L}\p{N} \x09-\x0D]+", "")).cast("long").alias("n_signs"))
    df = df.withColumns({"lines": F.filter("lines", lambda x: x.rlike(r"[^ \x09-\x0D]")), "n_words": F.size("w").cast("long")})
    stutter = F.filter("w", lambda x, i: F.when(i > 0, F.get(F.col("w"), i - 1) == x).otherwise(F.lit(False)))
    df = df.select("id", "n_words", "n_symbols", "n_upper", "n_marks", "n_signs", F.size(stutter).cast("long").alias("n_stutter"), "w", F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                   F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    nth = lambda a, i: F.get(F.col(a), i)
    windows = F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(0))),
                          lambda x, i: F.xxhash64(x, *(nth("w", i + k) for k in range(1, window))))
    df = df.withColumn("h", windows).drop("w")
    df = df.withColumn("s", F.when(F.size("h") > F.size(F.array_distinct("h")), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("h")
    same = lambda i, e: F.coalesce(nth("s", i)["x"] == e["x"], F.lit(False))
    df = df.withColumn("p", F.filter("s", lambda e, i: F.when(i > 0, same(i - 1, e)).otherwise(F.lit(False)) | same(i + 1, e))).drop("s")
    df = df.withColumn("p", F.sort_array(F.transform("p", lambda e: e["i"])))
    covered = F.aggregate(F.transform("p", lambda v, k: F.least(F.lit(window), F.coalesce(nth("p", k + 1) - v, F.lit(window)))), F.lit(0), lambda a, v: a + v)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")


def vote(value: str, good: float, bad: float) -> Column:
    x = F.expr(f"double({value})")
    return F.when(x > bad, -1).when(x <= good, 1).otherwise(0)


def fit(votes: DataFrame, rules: list[str], rounds: int = 30) -> DataFrame:
    """One row: prior double, on_good and on_bad array<double> (how often a rule that votes on such a document votes
    bad), by EM over the counted vote patterns."""
    table = votes.groupBy(F.array(*rules).alias("v")).agg(F.count("*").cast("double").alias("n"))
    table = table.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("table"))  # 3^rules rows at most
    k = len(rules)
    start = f"named_struct('prior', 0.8D, 'on_good', array_repeat(0.05D, {k}), 'on_bad', array_repeat(0.4D, {k}))"
    bad = lambda p: f"zip_with(r.v, m.{p}, (x, a) -> CASE x WHEN -1 THEN ln(a) WHEN 1 THEN ln(1 - a) ELSE 0D END)"
    odds = f"aggregate(zip_with({bad('on_good')}, {bad('on_bad')}, (x, y) -> x - y), ln(m.prior / (1 - m.prior)), (s, x) -> s + x)"
    step = f"transform(table, r -> named_struct('v', r.v, 'n', r.n, 'q', 1 / (1 + exp(-{odds}))))"
    # ten documents at the starting values are added, so that no rate reaches 0 or 1; a bad vote never speaks for a document
    rate = lambda w, a: f"aggregate({{q}}, {10 * a}D, (s, r) -> s + r.n * {w} * IF(r.v[j] = -1, 1, 0)) / aggregate({{q}}, 10D, (s, r) -> s + r.n * {w} * abs(r.v[j]))"
    new = f"""named_struct(
      'prior', aggregate({{q}}, 8D, (s, r) -> s + r.n * r.q) / aggregate({{q}}, 10D, (s, r) -> s + r.n),
      'on_good', transform(sequence(0, {k - 1}), j -> least(0.3D, {rate('r.q', 0.05)})),
      'on_bad', transform(sequence(0, {k - 1}), j -> greatest(least(0.3D, {rate('r.q', 0.05)}), least(0.98D, {rate('(1 - r.q)', 0.4)}))))"""
    # the array of one element binds the posteriors once a round
    body = f"element_at(transform(array({step}), q -> {new.format(q='q')}), 1)"
    return table.selectExpr(f"aggregate(sequence(1, {rounds}), {start}, (m, k) -> {body}) AS m").select("m.*")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict = RULES, threshold: float = 0.5, rounds: int = 30) -> DataFrame:
    """measures() of every row with base_failed, the votes, posterior (of good) and kept."""
    own = measures(docs, id_col, text_col).withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))
    own = kept(own.withColumns({f"vote_{k}": vote(*x) for k, x in rules.items()}))
    names = [f"vote_{k}" for k in rules]
    model = kept(fit(own, names, rounds))  # one row
    said = lambda v, a: F.when(F.col(v) == -1, F.ln(a)).when(F.col(v) == 1, F.ln(1 - a)).otherwise(0.0)
    odds = sum((said(v, F.get("on_good", F.lit(j))) - said(v, F.get("on_bad", F.lit(j))) for j, v in enumerate(names)), F.ln(F.col("prior") / (1 - F.col("prior"))))
    out = own.crossJoin(F.broadcast(model)).withColumn("posterior", 1 / (1 + F.exp(-odds))).drop(*model.columns)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
