"""Lemmas by rules of suffixes with a list of exceptions, both learnt from pairs of tokens and lemmas (inventory T3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.session import cut_lineage

#: Letters of a suffix, and the pairs it takes to make a rule.
LONGEST, SUPPORT = 6, 3
#: Rules go into every plan as one map; more than these are refused.
MOST_RULES = 10_000


def _ending(token: Column, lemma: Column) -> Column:
    """The number of letters the token loses and what it gets instead, as ``<number>:<letters>``."""
    shared = F.size(F.filter(F.sequence(F.lit(1), F.least(F.length(token), F.length(lemma))), lambda i: F.substring(token, F.lit(1), i) == F.substring(lemma, F.lit(1), i)))
    both = F.when((F.length(token) == 0) | (F.length(lemma) == 0), 0).otherwise(shared)
    return F.concat((F.length(token) - both).cast("string"), F.lit(":"), F.substr(lemma, both + 1))


def apply_rule(token: Column, rule: Column) -> Column:
    """The token with a rule's ending; unchanged without a rule."""
    cut = F.substring_index(rule, ":", 1).cast("int")
    changed = F.concat(F.substring(token, F.lit(1), F.length(token) - cut), F.substr(rule, F.locate(":", rule) + 1))
    return F.coalesce(changed, token)


def longest_rule(token: Column, rules: Column, longest: int = LONGEST) -> Column:
    """The rule of the longest suffix of the token that has one: a walk from the long suffixes to the short ones."""
    tried = [F.when(F.length(token) > n, F.element_at(rules, F.right(token, F.lit(n)))) for n in range(longest, 0, -1)]
    return F.coalesce(*tried)


def rule_map(rules: Mapping[str, str]) -> Column:
    """Rules (suffix to ``<letters lost>:<letters instead>``) as a map of the plan."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    if not rules:
        return F.from_json(F.lit("{}"), "map<string,string>")
    return F.map_from_arrays(F.array(*map(F.lit, rules)), F.array(*map(F.lit, rules.values())))


def learn_rules(pairs: DataFrame, longest: int = LONGEST, support: int = SUPPORT) -> tuple[dict[str, str], DataFrame]:
    """Rules and exceptions from ``pairs`` (token, lemma): {suffix: ending}, (token, lemma).

    Every suffix of up to ``longest`` letters, the token being longer, votes with its pairs' endings; the ending with most votes is its rule
    if it has ``support`` of them, the first by text on ties. A rule that says what the next shorter one with a rule
    says is left out. Pairs that the rules get wrong are the exceptions. With the rules and the exceptions every given pair comes out
    right; of several lemmas of one token the first by text counts. Null tokens and lemmas are left out.
    """
    known = pairs.where("token is not null and lemma is not null").groupBy("token").agg(F.min("lemma").alias("lemma"))
    known = cut_lineage(known.withColumn("ending", _ending(F.col("token"), F.col("lemma"))))
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("token") - 1)))
    votes = known.where(F.length("token") > 1).withColumn("_n", sizes).select(F.right("token", F.col("_n")).alias("suffix"), "ending")
    counted = votes.groupBy("suffix", "ending").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("suffix").agg(F.min(F.struct((-F.col("n")).alias("n"), "ending")).alias("b"))
    best = best.where(-F.col("b.n") >= support).select("suffix", F.col("b.ending").alias("ending"))
    # Next to every suffix the shorter ones, of which the longest with a rule counts.
    shorter = best.where(F.length("suffix") > 1).withColumn("_m", F.explode(F.sequence(F.lit(1), F.length("suffix") - 1)))
    shorter = shorter.select("suffix", F.right("suffix", F.col("_m")).alias("_s"), "_m")
    other = best.select(F.col("suffix").alias("_s"), F.col("ending").alias("_e"))
    behind = shorter.join(other, "_s").groupBy("suffix").agg(F.max_by("_e", "_m").alias("_e"))
    needed = best.join(behind, "suffix", "left").where(~F.col("ending").eqNullSafe(F.coalesce("_e", F.lit("0:"))))
    rules = {r["suffix"]: r["ending"] for r in needed.select("suffix", "ending").orderBy("suffix").limit(MOST_RULES + 1).collect()}
    said = apply_rule(F.col("token"), longest_rule(F.col("token"), rule_map(rules), longest))
    return rules, known.where(said != F.col("lemma")).select("token", "lemma")


def lemmas_of(tokens: DataFrame, rules: Mapping[str, str], exceptions: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(token, lemma) of distinct lower-case ``tokens`` (token): the exception's lemma, else that of the longest suffix with a rule.

    The table serves ``lemmatize`` as its dictionary.
    """
    own = exceptions.groupBy("token").agg(F.min("lemma").alias("_own"))
    ruled = apply_rule(F.col("token"), longest_rule(F.col("token"), rule_map(rules), longest))
    return tokens.select("token").distinct().join(own, "token", "left").select("token", F.coalesce("_own", ruled).alias("lemma"))
