"""Names: normalization, keys, search variants and the match score, as column functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tessera.functions.ratio import ratios

# Fixed values.
CACHE_KEY_VERSION = "v2-minjust"
LEGAL_FORM_WORDS = (
    "ооо", "оао", "зао", "пао", "ано", "нко", "фонд", "ассоциация", "автономная", "некоммерческая", "организация", "компания", "общество", "ограниченной", "ответственностью",
    "акционерное", "учреждение", "limited", "ltd", "llc", "inc", "corp", "corporation", "foundation",
)

#: Between variants in one text: a control character that NFKC leaves alone and that no letter combines with.
VARIANT_END = "\x00"
#: Texts of these characters are their own NFKC form, so they need no Python.
STABLE = r"^[\x00-\x7FЁА-яё«»]*$"


@F.pandas_udf(StringType())
def _nfkc(names: pd.Series) -> pd.Series:
    return names.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(name: Column) -> Column:
    """NFKC form; only names with other than plain characters reach the Arrow UDF, the rest pass it as nulls."""
    return F.coalesce(_nfkc(F.when(~name.rlike(STABLE), name)), name)


def normalize_plain(name: Column) -> Column:
    """normalize_name() of a text that is in NFKC form: built-in functions only."""
    lowered = F.translate(F.lower(name), "ё", "е")
    return F.trim(F.regexp_replace(lowered, "(?iu)[^a-zа-я0-9]+", " "))


def normalize_name(name: Column) -> Column:
    """Lower case, ё as е, everything but Latin and Russian letters and digits as single spaces."""
    return normalize_plain(nfkc(name))


def tokens(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda t: t != "")


def token_key(normalized: Column) -> Column:
    """Sorted tokens, repeats kept."""
    return F.array_join(F.sort_array(tokens(normalized)), " ")


def _legal() -> Column:
    return F.array(*map(F.lit, LEGAL_FORM_WORDS))


def core_tokens(normalized: Column) -> Column:
    """Sorted tokens that are no legal form."""
    return F.sort_array(F.filter(tokens(normalized), lambda t: ~F.array_contains(_legal(), t)))


def organization_key(normalized: Column) -> Column:
    return F.array_join(core_tokens(normalized), " ")


def _strip(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def raw_variants(name: Column) -> Column:
    """The name, its part before the first quote, each quoted part and its pieces, each part in parentheses."""
    prefix = F.regexp_replace(F.regexp_extract(name, '^([^"«]*)["«]', 1), "^[ ,;:-]+|[ ,;:-]+$", "")
    quoted = F.transform(F.regexp_extract_all(name, F.lit('("[^"]+"|«[^»]+»)'), F.lit(1)), lambda q: _strip(q.substr(F.lit(2), F.length(q) - 2)))
    parts = F.flatten(F.transform(F.filter(quoted, lambda q: q != ""), lambda q: F.concat(F.array(q), F.filter(F.transform(F.split(q, "[,;]"), _strip), lambda p: p != ""))))
    inner = F.filter(F.transform(F.regexp_extract_all(name, F.lit(r"\(([^)]+)\)"), F.lit(1)), _strip), lambda p: p != "")
    return F.concat(F.array(name), F.filter(F.array(prefix), lambda p: p != ""), parts, inner)


def search_names(name: Column, entity_type: Column, plain: bool = False) -> Column:
    """Normalized variants under which a name is found, in order, without repeats.

    Quotes and parentheses are found in the name as given; each variant is then normalized, through its NFKC form unless plain
    says that the name is in that form. The variants go to the Arrow UDF as one text, and only where one is not plain.
    """
    variants = raw_variants(name)
    if not plain:
        whole = F.array_join(variants, VARIANT_END)
        variants = F.when(name.rlike(STABLE), variants).otherwise(F.split(nfkc(whole), VARIANT_END))
    variants = F.transform(variants, normalize_plain)

    def more(value: Column) -> Column:
        t = tokens(value)
        two = lambda a, b: F.concat_ws(" ", F.element_at(t, a), F.element_at(t, b))
        pairs = F.when((entity_type == "person") & (F.size(t) >= 3), F.array(two(1, 2), two(2, 1), two(1, -1), two(-1, 1)))
        short = F.when(entity_type == "organization", F.array(organization_key(value)))
        empty = F.array().cast("array<string>")
        return F.concat(F.array(value), F.coalesce(short, empty), F.coalesce(pairs, empty))

    return F.array_distinct(F.filter(F.flatten(F.transform(variants, more)), lambda x: x != ""))


def cache_key(normalized: Column, entity_type: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(CACHE_KEY_VERSION), entity_type, normalized), 256)


def shard_of(key: Column, shards: int) -> Column:
    """The first 64 bits of a key, unsigned, modulo the number of shards."""
    return F.pmod(F.conv(F.substring(key, 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(shards).cast("decimal(20,0)")).cast("int")


def overlap(left: Column, right: Column) -> tuple[Column, Column, Column]:
    """Whether two token arrays are equal as sets, their Jaccard similarity and their containment."""
    a, b = F.array_distinct(left), F.array_distinct(right)
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return (both == F.size(a)) & (both == F.size(b)), F.try_divide(both, union), F.try_divide(both, F.least(F.size(a), F.size(b)))


def score_bound(jaccard: Column, containment: Column, ratio: Column | None = None) -> Column:
    """No match score of a pair is higher: both sequence ratios are `ratio` at most, 1 if it is not given."""
    ratio = F.lit(1.0) if ratio is None else ratio
    return F.greatest(0.45 * ratio + 0.35 * jaccard + 0.20 * containment, 0.55 * ratio + 0.30 * jaccard + 0.15 * containment)


def ratio_bound(a: Column, b: Column) -> Column:
    """No sequence ratio of two joined token lists that differ as sets is higher."""
    return length_bound(*(F.length(F.array_join(t, " ")) for t in (a, b)))


def length_bound(x: Column, y: Column) -> Column:
    """The sequence ratio of two unequal texts of these lengths: at most the shorter one's symbols match, all but one of equally long ones."""
    return F.coalesce(F.try_divide(2.0 * F.least(x, y, F.floor((x + y - 1) / 2)), x + y), F.lit(1.0))


@F.pandas_udf(DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio, arguments in this order (it is not symmetric)."""
    return pd.Series(ratios(*(pa.array(texts, pa.large_string(), from_pandas=True) for texts in (left, right))))


def plain_score(left: Column, right: Column, a: Column, b: Column, equal: Column) -> Column:
    """The score where a comparison as sets decides, else null."""
    return F.when((left == "") | (right == ""), 0.0).when(left == right, 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).when(equal, 0.99)


def score_from(plain: Column, a: Column, b: Column, jaccard: Column, containment: Column) -> Column:
    """The plain score of two names with tokens a and b, or else the one from the ratios: only then are they computed."""
    open_ = plain.isNull()
    s1 = sequence_ratio(F.when(open_, F.array_join(a, " ")), F.when(open_, F.array_join(b, " ")))
    # Tokens that are sorted already, as those of organizations, have one ratio.
    open_ = open_ & ((a != F.sort_array(a)) | (b != F.sort_array(b)))
    s2 = F.coalesce(sequence_ratio(F.when(open_, F.array_join(F.sort_array(a), " ")), F.when(open_, F.array_join(F.sort_array(b), " "))), s1)
    return F.coalesce(plain, F.greatest(0.45 * s1 + 0.35 * jaccard + 0.20 * containment, 0.55 * s2 + 0.30 * jaccard + 0.15 * containment))


def match_score(left: Column, right: Column, entity_type: Column) -> Column:
    """Score of two normalized names, 0 to 1."""
    organization = entity_type == "organization"
    a, b = (F.when(organization, core_tokens(x)).otherwise(tokens(x)) for x in (left, right))
    equal, jaccard, containment = overlap(a, b)
    return score_from(plain_score(left, right, a, b, equal), a, b, jaccard, containment)
