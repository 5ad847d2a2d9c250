"""Names and texts: normalizing, tokens, entity matching.  All native columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import BODY_WORDS, MAX_CHARS, MAX_WORDS, STOP_TOKENS


def _stop_words() -> Column:
    return F.expr("array(" + ", ".join(f"'{w}'" for w in STOP_TOKENS) + ")")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def norm(c: Column) -> Column:
    """Lower case, no punctuation, single blanks; an edge blank may stay where punctuation was."""
    bare = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), r"[^\p{L}\p{N}_\s]", "")
    return F.regexp_replace(bare, r"\s+", " ")


def words(c: Column) -> Column:
    """Normalized words longer than one character."""
    return _words(norm(c))


def _words(n: Column) -> Column:
    return F.filter(F.split(n, " "), lambda t: F.length(t) > 1)


def tokens(c: Column) -> Column:
    """Distinct words that are no stop words."""
    return _tokens(norm(c))


def _tokens(n: Column) -> Column:
    return F.array_distinct(F.array_except(_words(n), _stop_words()))


def acronym(c: Column) -> Column:
    """Initials of two words or more, stop words included; else empty."""
    return _acronym(norm(c))


def _acronym(n: Column) -> Column:
    w = _words(n)
    return F.when(F.size(w) >= 2, F.array_join(F.transform(w, lambda t: F.left(t, F.lit(1))), "")).otherwise("")


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def deal_key(target: Column, seller: Column, stage: Column) -> Column:
    return F.concat_ws("|", norm(target), norm(seller), F.lower(F.coalesce(stage, F.lit(""))))


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def profile(target: Column, seller: Column) -> Column:
    """What matching needs of a deal's names, computed once a row."""
    return profile_of(norm(target), norm(seller))


def profile_of(n: Column, s: Column) -> Column:
    """The profile of names that are normalized."""
    return F.struct(
        n.alias("name"), _tokens(n).alias("tokens"), _acronym(n).alias("acronym"), F.regexp_replace(n, r"[^\p{L}\p{N}_]", "").alias("solid"),
        s.alias("seller"), _tokens(s).alias("seller_tokens"), F.array_except(_tokens(n), _tokens(s)).alias("own"), less(less(n, s), s).alias("bare"),
    )


def less(name: Column, seller: Column) -> Column:
    """A name without a seller's."""
    return F.when(seller == "", name).otherwise(F.trim(F.replace(name, seller, F.lit(""))))


def same_target(a: Column, b: Column) -> Column:
    """Whether two profiles' targets mean one entity: whether any of the rules holds."""
    one = a["seller"] == b["seller"]  # then each side's own rest and bare name will do
    sold = F.array_union(a["seller_tokens"], b["seller_tokens"])
    rests = F.array(F.when(one, F.struct(a["own"].alias("a"), b["own"].alias("b"))).otherwise(F.struct(F.array_except(a["tokens"], sold).alias("a"), F.array_except(b["tokens"], sold).alias("b"))))  # an array, so that it is computed once

    def by_tokens(x: Column) -> Column:
        def rule(common: Column) -> Column:
            joint = F.size(x["a"]) + F.size(x["b"]) - common  # both are distinct
            generic = (F.size(x["a"]) == 0) | (F.size(x["b"]) == 0)
            return (common >= 2) | ((common > 0) & (2 * common >= joint)) | (generic & F.arrays_overlap(a["seller_tokens"], b["seller_tokens"]))

        return F.exists(F.array(F.size(F.array_intersect(x["a"], x["b"]))), rule)

    without = lambda n: less(less(n, a["seller"]), b["seller"])
    bare = F.array(F.when(one, F.struct(a["bare"].alias("a"), b["bare"].alias("b"))).otherwise(F.struct(without(a["name"]).alias("a"), without(b["name"]).alias("b"))))
    contained = F.exists(bare, lambda x: (x["a"] != "") & (x["b"] != "") & (x["b"].contains(x["a"]) | x["a"].contains(x["b"])))
    prefix = _any([(F.length(s) >= 5) & F.startswith(a["name"], F.left(s, F.lit(4))) & F.startswith(b["name"], F.left(s, F.lit(4))) for s in (a["seller"], b["seller"])])
    initials = (a["acronym"] != "") & (a["acronym"] == b["acronym"])
    short = lambda x, y: (x["acronym"] != "") & (F.startswith(y["solid"], x["acronym"]) | F.array_contains(y["tokens"], x["acronym"]))
    return _any([a["name"] == b["name"], initials, prefix, short(a, b), short(b, a), F.exists(rests, by_tokens), contained])


def same_deal(a: Column, b: Column) -> Column:
    """Sellers that both have tokens must share one; then the targets decide."""
    both = (F.size(a["seller_tokens"]) > 0) & (F.size(b["seller_tokens"]) > 0)
    return F.when(both & ~F.arrays_overlap(a["seller_tokens"], b["seller_tokens"]), False).otherwise(same_target(a, b))


def targets_match(ta: Column, sa: Column, tb: Column, sb: Column) -> Column:
    return same_target(profile(ta, sa), profile(tb, sb))


def deals_match(ta: Column, sa: Column, tb: Column, sb: Column) -> Column:
    return same_deal(profile(ta, sa), profile(tb, sb))


def url_hash(url: Column) -> Column:
    return F.left(F.sha2(url, 256), F.lit(16))


def split_words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def word_gate(c: Column, least: int = BODY_WORDS) -> Column:
    return F.size(split_words(c)) >= least


def cap_text(c: Column, max_words: int = MAX_WORDS, max_chars: int = MAX_CHARS) -> Column:
    """At most max_words words, then at most max_chars characters; white space stays where no word is cut."""
    w = split_words(c)
    return F.left(F.when(F.size(w) > max_words, F.array_join(F.slice(w, 1, max_words), " ")).otherwise(c), F.lit(max_chars))


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 1 << 30)))
