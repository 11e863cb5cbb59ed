"""Entities against the registry: exact, token-set and fuzzy tiers, with explicit ambiguity.

Every tier is an equi-join on exploded keys; the fuzzy tier's keys are the rare tokens that a pair of names must share to reach
the score asked for, so a token that most names hold joins few of them. Pairs are never exchanged to be made distinct: each is met at one
key (meet). The lookup and the counts do not expand the pairs of hot keys at all: they need the least and the greatest name of a key, or
the sizes of classes of alike rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names, urls
from tessera.operators.registry import is_active
from tessera.operators.tables import cut

EXACT, FUZZY = "exact", "fuzzy"
# Fixed values.
SHORT_NAME_NOTE = "Реестр: один короткий вариант имени соответствует нескольким записям."
CLOSE_NOTE = "Реестр: близкие совпадения: "


def type_fits(entity_type: Column, record_type: Column) -> Column:
    return (entity_type == "unknown") | (entity_type == record_type)


def with_search_names(entities: DataFrame, plain: bool = False) -> DataFrame:
    return entities.withColumn("search_names", names.search_names(F.col("name"), F.col("entity_type"), plain))


#: Rows of a key that meet in one block, on each side, while that makes DEALT blocks of a side at most; then blocks grow up to MOST rows.
BLOCK, DEALT, MOST = 1024, 4, 8192
#: A key of more right rows than this is hot.
HOT = 64


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """Dealt by columns into as many partitions as the session sets: these are not merged for being small, since few bytes can make many pairs."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def key_rows(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.explode(F.array_distinct("keys")).alias("key")).drop("keys")


def key_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """key, n_left and n_right of the keys that both sides hold."""
    sides = (key_rows(rows).groupBy("key").agg(F.count("*").alias(name)) for rows, name in ((left, "n_left"), (right, "n_right")))
    return next(sides).join(next(sides), "key")


def with_shared_keys(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct rows (all columns but keys) with their shared keys as structs, those of most pairs first; rows without one are dropped."""
    columns = [c for c in rows.columns if c != "keys"]
    order = F.struct((-F.col("n_left") * F.col("n_right")).alias("pairs"), "key", "n_left", "n_right")
    return key_rows(rows).join(counts, "key").groupBy(*columns).agg(F.sort_array(F.collect_set(order)).alias("shared"))


def blocks(n: Column) -> Column:
    """Into how many blocks n rows of a key are dealt: each is sent to all blocks of the other side, so there are few."""
    return F.greatest(F.least(F.ceil(n / BLOCK), F.lit(DEALT)), F.ceil(n / MOST)).cast("int")


def meet(left: DataFrame, right: DataFrame, alike: tuple[str, ...] = (), ahead: dict[str, Column] | None = None) -> DataFrame:
    """Every pair of a left and a right row with a common key (keys: array of strings), once, with the other columns of both.

    The keys of a row are ordered, those of most pairs first, and a pair stays at its first common key, which both rows tell by their
    own keys; so pairs are not exchanged. A hot key is the first of nearly all of its rows. The rows of a key are dealt
    into blocks, and each left block meets each right one in some task. The right rows of a block that are alike in the keys
    before this one, and in the columns `alike`, travel and meet a left row as one list, so what these tell is found once for
    all of them: whether the pairs stay, and `ahead`, further columns from left and alike ones. Rows of which one is null are left out.
    """
    counts = key_counts(left, right)
    ahead = ahead or {}

    def side(rows: DataFrame, mine: str, other: str) -> DataFrame:
        columns = [F.col(c) for c in rows.columns if c != "keys"]
        made = with_shared_keys(rows, counts).select(*columns, "shared.key", F.posexplode("shared").alias("at", "k"))
        own = F.pmod(F.xxhash64(*columns), blocks(F.col(f"k.n_{mine}"))).cast("int").alias(f"{mine}_block")
        return made.select(*columns, F.col("k.key").alias("met"), F.slice("key", 1, F.col("at")).alias(f"{mine}_before"), own, blocks(F.col(f"k.n_{other}")).alias("others"))

    def sent(rows: DataFrame, other: str) -> DataFrame:
        rows = rows.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).drop("others")
        return spread(rows, "met", "left_block", "right_block")

    single = [c for c in right.columns if c not in ("keys", *alike)]
    lists = side(right, "right", "left").groupBy("met", "right_block", "others", "right_before", *alike).agg(F.collect_list(F.struct(*single)).alias("rows"))
    pairs = sent(side(left, "left", "right"), "right").join(sent(lists, "left").hint("merge"), ["met", "left_block", "right_block"]).where(~F.arrays_overlap("left_before", "right_before"))
    kept = [c for c in left.columns if c != "keys"] + list(alike)
    pairs = pairs.select(*kept, *(value.alias(name) for name, value in ahead.items()), "rows").where(" AND ".join(f"{name} IS NOT NULL" for name in ahead) or "true")
    return pairs.select(*kept, *ahead, F.inline("rows"))


def pair_counts(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
    """Left rows (all columns but keys) with n, the number of distinct right rows with a common key, for each value of the right columns `by`.

    Rows are alike where their hot keys are: of such classes only the sizes are needed, and pairs of classes are few. What shares
    no hot key meets at a key of HOT right rows at most.
    """
    of_left, of_right = ([c for c in rows.columns if c != "keys"] for rows in (left, right))
    counts = key_counts(left, right)
    hot = lambda is_hot: F.transform(F.filter("shared", lambda k: (k["n_right"] > HOT) == is_hot), lambda k: k["key"])
    one, two = (with_shared_keys(rows, counts).select(*columns, hot(True).alias(f"{name}_hot"), hot(False).alias("keys")) for rows, columns, name in ((left, of_left, "left"), (right, of_right, "right")))
    classes = two.groupBy("right_hot", *by).agg(F.count("*").alias("n")).withColumn("keys", F.col("right_hot"))
    sizes = meet(one.select("left_hot", F.col("left_hot").alias("keys")), classes).groupBy("left_hot", *by).agg(F.sum("n").alias("n"))
    rare = meet(one, two).where(~F.arrays_overlap("left_hot", "right_hot")).groupBy(*of_left, *by).agg(F.count("*").alias("n"))
    return one.join(sizes, "left_hot").select(*of_left, *by, "n").unionByName(rare).groupBy(*of_left, *by).agg(F.sum("n").alias("n"))


def rated_pairs(left: DataFrame, right: DataFrame, rate: Callable[[Column, Column], Column]) -> DataFrame:
    """cache_key, record_id and rated of the pairs that share a key and are not rated null.

    left: cache_key, a (its tokens, each once) and keys; right: record_id, sets (such token lists) and keys. rate takes what is common to a
    and each of the sets, as an array of structs of both (the number of common tokens) and size (that of the set) in any order and without repeats,
    and the size of a. Tokens are common if more than HOT right rows hold them. Most pairs share no others: what these are rated is that of the common
    tokens, so it is found for all alike rows ahead. Pairs that share others meet at these, and their sets are compared one by one.
    """
    tokens_of = lambda rows, key, held: rows.select(key, F.explode(F.array_distinct(held)).alias("token"))
    every = F.flatten("sets")
    common = tokens_of(right, "record_id", every).distinct().groupBy("token").count().where(F.col("count") > HOT).select("token")

    def parted(rows: DataFrame, key: str, held: Column) -> DataFrame:
        """With known, the row's common tokens, rest, the others, and a signature of these."""
        known = tokens_of(rows, key, held).join(common, "token").groupBy(key).agg(F.collect_set("token").alias("known"))
        rows = rows.join(known, key, "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
        return rows.withColumn("rest", F.array_except(held, F.col("known"))).withColumn("bits", signature(F.col("rest")))

    one, two = cut(parted(left, "cache_key", F.col("a"))), cut(parted(right, "record_id", every))
    alike = F.transform("sets", lambda s: F.struct(F.array_sort(F.array_intersect(s, F.col("known"))).alias("held"), F.size(s).alias("size")))
    numbers = lambda sets, a, of: F.array_distinct(F.transform(sets, lambda s: F.struct(F.size(F.array_intersect(a, of(s)[0])).alias("both"), of(s)[1].alias("size"))))
    ahead = rate(numbers("alike", F.col("known"), lambda s: (s["held"], s["size"])), F.col("a_size"))
    met = meet(
        one.select("cache_key", F.array_sort(F.array_intersect("a", "known")).alias("known"), F.size("a").alias("a_size"), "rest", "bits", "keys"),
        two.select("record_id", F.array_sort(F.array_distinct(alike)).alias("alike"), F.col("rest").alias("other_rest"), F.col("bits").alias("other_bits"), "keys"),
        ("alike",), {"rated": ahead},
    )
    apart = (F.col("bits").bitwiseAND(F.col("other_bits")) == 0) | ~F.arrays_overlap("rest", "other_rest")
    near = meet(
        one.select("cache_key", "a", F.col("keys").alias("left_keys"), F.col("rest").alias("keys")), two.select("record_id", "sets", F.col("keys").alias("right_keys"), F.col("rest").alias("keys"))
    ).where(F.arrays_overlap("left_keys", "right_keys"))
    # Exploded, so that the test below does not compute it again.
    single = F.explode(F.array(rate(numbers("sets", F.col("a"), lambda s: (s, F.size(s))), F.size("a")))).alias("rated")
    return met.where(apart).select("cache_key", "record_id", "rated").unionByName(near.select("cache_key", "record_id", single).where("rated IS NOT NULL"))


def typed(keys: Column, *kinds: Column) -> Column:
    """Keys under each of the types that is not null."""
    return F.array_distinct(F.flatten(F.transform(F.array_compact(F.array(*kinds)), lambda kind: F.transform(keys, lambda k: F.concat_ws(":", kind, k)))))


def entity_keys(keys: Column) -> Column:
    return typed(keys, F.col("entity_type")).alias("keys")


def record_keys(keys: Column) -> Column:
    """Records are found under their type and, by entities without one, as unknown."""
    return typed(keys, F.col("entity_type"), F.lit("unknown")).alias("keys")


#: Keys of the exact tier: the sorted tokens of equal names are equal, so one key finds both kinds of match.
def sorted_names() -> Column:
    return F.transform("search_names", names.token_key)


def name_tokens() -> Column:
    return F.array_distinct(F.flatten(F.transform("search_names", names.tokens)))


def exact_pairs(entities: DataFrame, records: DataFrame) -> DataFrame:
    """cache_key and record_id of pairs that share a search name or its sorted tokens, types fitting."""
    return meet(entities.select("cache_key", entity_keys(sorted_names())), records.select("record_id", record_keys(sorted_names())))


def blocking_pairs(entities: DataFrame, records: DataFrame) -> DataFrame:
    """cache_key and record_id of pairs that share a token, types fitting."""
    return meet(entities.select("cache_key", entity_keys(name_tokens())), records.select("record_id", record_keys(name_tokens())))


def exact_names(entities: DataFrame, records: DataFrame) -> DataFrame:
    """cache_key of entities with an exact pair, with the least and the greatest name of their records: from those of each key, without the pairs."""
    least, greatest = F.min("low").alias("low"), F.max("high").alias("high")
    found = key_rows(records.select(F.col("normalized_name").alias("low"), F.col("normalized_name").alias("high"), record_keys(sorted_names()))).groupBy("key").agg(least, greatest)
    return key_rows(entities.select("cache_key", entity_keys(sorted_names()))).join(found, "key").groupBy("cache_key").agg(least, greatest)


def without_exact(entities: DataFrame, records: DataFrame) -> DataFrame:
    return entities.join(exact_names(entities, records), "cache_key", "left_anti")


def named_pairs(wanted: DataFrame, records: DataFrame) -> DataFrame:
    """cache_key and record_id of the exact pairs whose record has the wanted name (wanted: cache_key, record_name and keys)."""
    right = records.select("record_id", F.col("normalized_name").alias("record_name"), record_keys(sorted_names()).alias("record_keys"))
    return wanted.join(right, "record_name").where(F.arrays_overlap("keys", "record_keys")).select("cache_key", "record_id").distinct()


def primary_pairs(entities: DataFrame, records: DataFrame) -> DataFrame:
    """Exact pairs of equal names."""
    return named_pairs(entities.select("cache_key", F.col("normalized_name").alias("record_name"), entity_keys(sorted_names())), records)


def candidates(entities: DataFrame, records: DataFrame) -> DataFrame:
    """cache_key, record_id and tier: blocking only for entities without an exact pair."""
    exact = exact_pairs(entities, records)
    return exact.withColumn("tier", F.lit(EXACT)).unionByName(blocking_pairs(without_exact(entities, records), records).withColumn("tier", F.lit(FUZZY)))


def candidate_counts(entities: DataFrame, records: DataFrame) -> DataFrame:
    """cache_key, tier and n: the number of candidates, without expanding them."""
    count = lambda rows, keys: pair_counts(rows.select("cache_key", entity_keys(keys)), records.select("record_id", record_keys(keys)))
    fuzzy = count(without_exact(entities, records), name_tokens()).withColumn("tier", F.lit(FUZZY))
    return count(entities, sorted_names()).withColumn("tier", F.lit(EXACT)).unionByName(fuzzy).select("cache_key", "tier", "n")


def name_rows(entities: DataFrame, records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs with the entity's name, each of the record's search names and the tokens of both."""
    left = entities.select("cache_key", F.col("normalized_name").alias("name_key"))
    right = records.select("record_id", F.col("entity_type").alias("kind"), F.explode("search_names").alias("search_name"))
    rows = pairs.join(left, "cache_key").join(right, "record_id")
    return rows.withColumns({"a": kind_tokens("name_key"), "b": kind_tokens("search_name")}).select("cache_key", "record_id", "tier", "name_key", "search_name", "a", "b")


def kind_tokens(name: str) -> Column:
    """Tokens of a name; those of organizations without legal forms. Types fit, so the record's type is the pair's."""
    return F.when(F.col("kind") == "organization", names.core_tokens(F.col(name))).otherwise(names.tokens(F.col(name)))


#: Names of so many distinct tokens at most meet at the tokens they must share, longer ones at single tokens.
SHORT = 8


def shared_bound(shared: Column, one: Column, other: Column) -> Column:
    """No score of names of `one` and `other` distinct tokens that share `shared` at most is higher (of those that sets do not decide)."""
    k = F.least(shared, one, other)
    return names.score_bound(k / (one + other - k), k / F.least(one, other))


def signature(held: Column) -> Column:
    """64 bits, one for each token's hash: what is set in one signature only stands for a token of one name only."""
    return F.aggregate(held, F.lit(0).cast("long"), lambda bits, t: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))))


def needed(least: float, scored: bool = False) -> list[list[int]]:
    """For names of i + 1 and k + 1 distinct tokens, both short: how many they must share to reach the bound; 0 if none is enough.

    With `scored`: to have a score of `least`, which is under the bound unless all tokens are shared.
    """
    bound = lambda k, a, b: max(0.45 + 0.35 * k / (a + b - k) + 0.20 * k / min(a, b), 0.55 + 0.30 * k / (a + b - k) + 0.15 * k / min(a, b))
    enough = lambda k, a, b: bound(k, a, b) >= least - 1e-9 if k == a == b or not scored else bound(k, a, b) > least + 1e-9
    sizes = range(1, SHORT + 1)
    return [[next((k for k in range(1, min(a, b) + 1) if enough(k, a, b)), 0) for b in sizes] for a in sizes]


def combinations(found: Column, of: Column) -> Column:
    """Runs of 2 to 4 (`of`) of the tokens in order, as one text each, and the position of the last."""
    first = F.transform(found, lambda t, i: F.struct(t.alias("token"), (i + 1).alias("at")))

    def longer(made: Column) -> Column:
        return F.flatten(F.transform(made, lambda x: F.transform(F.slice(found, x["at"] + 1, F.size(found)), lambda t, j: F.struct(F.concat(x["token"], F.lit(" "), t).alias("token"), (x["at"] + 1 + j).alias("at")))))

    three = urls.let(longer(first), lambda made: F.when(of >= 3, longer(made)).otherwise(made))
    return urls.let(three, lambda made: F.when(of >= 4, longer(made)).otherwise(made))


def near_keys(left: DataFrame, right: DataFrame, least: float, scored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both sides of near_pairs with a row for each key: form, token, m (how many tokens that is), at (the position of the last), k (how many must be shared, if it is known), and what is known of the name."""
    held = lambda frame, tokens, name: frame.select("kind", F.explode(F.array_distinct(tokens)).alias("token")).groupBy("kind", "token").agg(F.count("*").alias(name))
    count = held(right, "b", "n").join(held(left, "a", "n_left"), ["kind", "token"]).drop("n_left")
    jaccard = min((least - 0.70) / 0.30, (least - 0.65) / 0.35)
    enough = F.lit(least - 1e-9)
    table = F.array(*(F.array(*map(F.lit, row)) for row in needed(least, scored)))

    def rows(frame: DataFrame, tokens: str, key: list[str]) -> DataFrame:
        """One row for each name: its tokens that count in order, h, size and signature."""
        single = frame.select(*key, F.size(F.array_distinct(tokens)).alias("size"), signature(F.array_distinct(tokens)).alias("bits"), F.explode(F.array_distinct(tokens)).alias("token"))
        found = single.join(count, ["kind", "token"]).groupBy(*key).agg(*(F.first(c).alias(c) for c in ("size", "bits")), F.array_sort(F.collect_list(F.struct("n", "token"))).alias("ordered"))
        return found.select(*key, "size", "bits", F.size("ordered").alias("h"), F.col("ordered.token").alias("ordered"))

    def sizes(frame: DataFrame, tokens: str) -> DataFrame:
        return frame.select(F.size(F.array_distinct(tokens)).alias("size")).where(f"size BETWEEN 1 AND {SHORT}").agg(F.collect_set("size").alias("sizes"))

    def keyed(frame: DataFrame, tokens: str, side: str, key: list[str], others: DataFrame) -> DataFrame:
        made, size, h, ordered = rows(frame, tokens, key), F.col("size"), F.col("h"), F.col("ordered")
        form = lambda name, token, at, m=F.lit(1), k=F.lit(1): F.struct((F.lit(name) if isinstance(name, str) else name).alias("form"), token.alias("token"), at.cast("int").alias("at"), m.alias("m"), k.alias("k"))
        named = lambda what, n: F.concat_ws(":", F.lit(what), *((size, n) if side == "left" else (n, size)))
        if jaccard <= 0:  # one shared token may be enough in names of any size
            keys = F.transform(ordered, lambda t, i: form("any", t, i + 1))
        else:
            fits = lambda shared: names.score_bound(F.least(shared, size) / size, F.lit(1.0)) >= enough
            # Alone: by both sizes, left one first; one shared token needs na + nb - 1 <= 1 / jaccard.
            alone_sizes = F.filter(F.sequence(F.lit(1), F.lit(max(1, int(1 / jaccard + 1e-6)))), lambda n: shared_bound(F.lit(1), size, n) >= enough)
            alone = F.flatten(F.transform(alone_sizes, lambda n: F.transform(ordered, lambda t, i: form(named("one", n), t, i + 1))))
            firsts = F.filter(F.transform(ordered, lambda t, i: F.struct(t.alias("t"), (i + 1).alias("at"))), lambda x: fits(h - x["at"] + 1))

            def several(n: Column) -> Column:
                """For partners of n tokens: m of the k tokens to be shared, which both names hold among their first h - k + m."""
                k = F.get(F.get(table, size - 1), n - 1)
                m = F.least(k, F.when(F.greatest(size, n) <= 6, 4).otherwise(3))
                made = combinations(F.slice(ordered, 1, F.greatest(h - k + m, F.lit(0))), m)
                return F.when((k >= 2) & (h >= k), F.transform(made, lambda x: form(named("several", n), x["token"], x["at"], m, k)))

            short = F.flatten(F.array_compact(F.transform("sizes", several)))
            meet_at = lambda name: F.transform(firsts, lambda x: form(name, x["t"], x["at"]))
            # Forms name the left name first.
            as_short, as_long = ("short-long", "long-short") if side == "left" else ("long-short", "short-long")
            keys = F.concat(alone, F.when(size <= SHORT, F.concat(short, meet_at(as_short))).otherwise(F.concat(meet_at("long-long"), meet_at(as_long))))
            made = made.crossJoin(F.broadcast(others))
        return made.select(*key, "size", "bits", "h", "ordered", F.explode(keys).alias("key")).select(*key, "size", "bits", "h", "ordered", "key.*")

    return keyed(left, "a", "left", ["cache_key", "kind"], sizes(right, "b")), keyed(right, "b", "right", ["record_id", "name_no", "kind"], sizes(left, "a"))


def near_pairs(left: DataFrame, right: DataFrame, least: float, scored: bool = False) -> DataFrame:
    """cache_key, kind, record_id and name_no of names that reach the bound `least`, with their shared tokens (both) and sizes.

    left: cache_key, kind and a; right: record_id, name_no, kind and b; a and b are token lists. The tokens of a name are ordered from
    the rarest on among the right ones; those that the other side does not hold are passed over. Two names that reach the bound share k tokens,
    of which the first stand early in both: where p is a token's position among the h that count, names that have it as first common
    token share h - p + 1 at most. So a name gives only its tokens of a high enough bound:

    - single tokens with both sizes, for names so short that one shared token is enough;
    - for each size of a short partner, groups of 2 to 4 of the k tokens that these sizes must share, so what most names hold
      is no key unless it is nearly all that is needed;
    - single tokens for names of which one at least is long.

    That is a fixed number of rows for a short name, and for each token of a long one. A met pair stays if its positions and signatures allow the bound and
    then, by its tokens, at its first common key alone. With `scored`, those are left out that differ and would need
    sequence ratios of 1.
    """
    x, y = (spread(side, "kind", "form", "token").alias(name) for side, name in zip(near_keys(left, right, least, scored), "xy"))
    enough = F.lit(least - 1e-9)
    same = (F.col("x.kind") == F.col("y.kind")) & (F.col("x.form") == F.col("y.form")) & (F.col("x.token") == F.col("y.token"))
    # At the first common key no more than this is shared.
    after = F.col("x.m") + F.least(F.col("x.h") - F.col("x.at"), F.col("y.h") - F.col("y.at"))
    only = lambda one, other: F.col(f"{one}.size") - F.bit_count(F.col(f"{one}.bits").bitwiseAND(F.bitwise_not(F.col(f"{other}.bits"))))
    bound = lambda shared: shared_bound(shared, F.col("x.size"), F.col("y.size"))
    shared = F.least(after, only("x", "y"), only("y", "x"))
    # One shared token that is enough is a key of its own.
    once = F.col("x.form").isin("short-long", "long-short", "long-long") & (bound(F.lit(1)) >= enough)
    na, nb = F.col("x.size"), F.col("y.size")
    # A cheap test first: no bound is reached under this Jaccard similarity.
    jaccard = max(0.0, min((least - 0.70) / 0.30, (least - 0.65) / 0.35))
    met = x.join(y, same & (shared >= F.greatest(F.col("x.k"), jaccard / (1 + jaccard) * (na + nb) - 1e-6)) & ~once)
    # As one element of an array, so that common tokens are found once for each pair.
    first = lambda common: F.array_join(F.slice(common, 1, F.col("x.m")), " ") == F.col("x.token")
    common = F.transform(F.array(F.array_intersect("x.ordered", "y.ordered")), lambda c: F.when(first(c), F.size(c)))
    found = met.select("x.cache_key", "x.kind", "y.record_id", "y.name_no", na.alias("na"), nb.alias("nb"), F.explode(F.array_compact(common)).alias("both"))
    return found.where(shared_bound(F.col("both"), F.col("na"), F.col("nb")) >= enough).select("cache_key", "kind", "record_id", "name_no", "both", "na", "nb")


def entity_names(entities: DataFrame) -> DataFrame:
    """cache_key, name_key, kind and a: entities of unknown type under each type."""
    kinds = F.when(F.col("entity_type") == "unknown", F.array(F.lit("person"), F.lit("organization"))).otherwise(F.array("entity_type"))
    return entities.select("cache_key", F.col("normalized_name").alias("name_key"), F.explode(kinds).alias("kind")).withColumn("a", kind_tokens("name_key"))


def record_names(records: DataFrame) -> DataFrame:
    """record_id, kind, search_name and b."""
    return records.select("record_id", F.col("entity_type").alias("kind"), F.explode("search_names").alias("search_name")).withColumn("b", kind_tokens("search_name"))


def near_names(left: DataFrame, right: DataFrame, least: float, scored: bool = False) -> DataFrame:
    """Rows of entity_names and record_names side by side, of all pairs of names that share a token and have a bound of `least`.

    Names of the same tokens are compared once. With `scored`, those are left out whose lengths keep their score under it.
    """
    one, other = F.array_join(F.sort_array("a"), " "), F.array_join(F.sort_array("b"), " ")
    left, right = left.withColumn("left_class", one), right.withColumn("right_class", other)
    pairs = near_pairs(left.select(F.col("left_class").alias("cache_key"), "kind", names.tokens(F.col("left_class")).alias("a")).distinct(), right.select(F.col("right_class").alias("record_id"), F.lit(0).alias("name_no"), "kind", names.tokens(F.col("right_class")).alias("b")).distinct(), least, scored)
    if scored:
        union = F.col("na") + F.col("nb") - F.col("both")
        reach = names.score_bound(F.col("both") / union, F.col("both") / F.least("na", "nb"), names.length_bound(F.length("cache_key"), F.length("record_id")))
        pairs = pairs.where(((F.col("both") == F.col("na")) & (F.col("both") == F.col("nb"))) | (reach >= least - 1e-9))
    pairs = pairs.select("kind", F.col("cache_key").alias("left_class"), F.col("record_id").alias("right_class"))
    return pairs.join(left, ["kind", "left_class"]).join(right, ["kind", "right_class"]).drop("left_class", "right_class")


def near_rows(entities: DataFrame, records: DataFrame, least: float) -> DataFrame:
    """As name_rows, of all pairs of an entity and a search name that share a token, fit in type and have a bound of `least`."""
    near = near_names(entity_names(entities), record_names(records), least)
    return near.select("cache_key", "record_id", F.lit(FUZZY).alias("tier"), "name_key", "search_name", "a", "b")


def near_scores(entities: DataFrame, records: DataFrame, threshold: float, margin: float) -> DataFrame:
    """The scores of the fuzzy tier's pairs that can reach threshold - margin. A record's names of the same tokens are scored once."""
    right = record_names(records).groupBy("record_id", "kind", "b").agg(F.collect_set("search_name").alias("search_names"))
    near = near_names(entity_names(entities), right, threshold - margin, scored=True)
    name = F.when(F.array_contains("search_names", F.col("name_key")), F.col("name_key")).otherwise(F.col("search_names")[0])
    return best_scores(near.select("cache_key", "record_id", F.lit(FUZZY).alias("tier"), "name_key", name.alias("search_name"), "a", "b"), threshold, margin, settle=False)


def near_bounds(entities: DataFrame, records: DataFrame, least: float, digits: int = 15) -> DataFrame:
    """cache_key, record_id and bound (to so many digits) of the pairs of which some name has a bound of `least`: the best of its names. Pairs are not exchanged."""
    left = entity_names(entities).select("cache_key", "kind", F.array_distinct("a").alias("a"))
    right = record_names(records).select("record_id", "kind", F.array_sort(F.array_distinct("b")).alias("b")).distinct()
    x, y = near_keys(left, right.select("record_id", F.array_join("b", " ").alias("name_no"), "kind", "b"), least)
    key = F.concat_ws("|", "kind", "form", "token")
    keys = lambda rows, column: rows.groupBy(column, "kind").agg(F.collect_set(key).alias("keys"))
    sets = right.groupBy("record_id", "kind").agg(F.collect_list("b").alias("sets"))

    def best(numbers: Column, size: Column) -> Column:
        found = F.array_max(F.transform(numbers, lambda n: F.when(n["both"] >= 1, names.score_bound(n["both"] / (size + n["size"] - n["both"]), n["both"] / F.least(size, n["size"])))))
        return urls.let(found, lambda bound: F.when(bound >= least - 1e-9, F.round(bound, digits)))

    rated = rated_pairs(left.join(keys(x, "cache_key"), ["cache_key", "kind"]).drop("kind"), sets.join(keys(y, "record_id"), ["record_id", "kind"]).drop("kind"), best)
    return rated.withColumnRenamed("rated", "bound")


def best_scores(rows: DataFrame, threshold: float, margin: float, settle: bool = True) -> DataFrame:
    """Pairs of name rows with the record's score: the best over its search names.

    A fuzzy pair of names that cannot reach threshold - margin is not scored: neither can it match, nor make a match
    ambiguous. The bound is a plain expression before the UDF, so those pairs never reach Python.
    """
    equal, jaccard, containment = names.overlap(F.col("a"), F.col("b"))
    rows = rows.withColumns({"equal": equal, "jaccard": jaccard, "containment": containment})
    rows = rows.withColumns({"plain": names.plain_score(F.col("name_key"), F.col("search_name"), F.col("a"), F.col("b"), F.col("equal")), "bound": names.score_bound(F.col("jaccard"), F.col("containment"), names.ratio_bound(F.col("a"), F.col("b")))})
    rows = rows.where((F.col("tier") == EXACT) | F.col("plain").isNotNull() | (F.col("bound") >= threshold - margin - 1e-9))
    if settle:  # A name whose bound does not exceed what another name of the pair scores for sure cannot be the pair's best.
        rows = rows.withColumn("sure", F.max("plain").over(Window.partitionBy("cache_key", "record_id")))
        rows = rows.where(F.col("plain").isNotNull() | F.col("sure").isNull() | (F.col("bound") > F.col("sure")))
    score = names.score_from(F.col("plain"), F.col("a"), F.col("b"), F.col("jaccard"), F.col("containment"))
    return rows.withColumn("score", score).groupBy("cache_key", "record_id", "tier").agg(F.max("score").alias("score"))


def scored(entities: DataFrame, records: DataFrame, pairs: DataFrame, threshold: float, margin: float) -> DataFrame:
    """The scores of given pairs (cache_key, record_id, tier)."""
    return best_scores(name_rows(entities, records, pairs), threshold, margin)


def with_standing(scores: DataFrame, records: DataFrame) -> DataFrame:
    """Scored pairs with what is known of the record and its standing: by score, active before excluded, number, then record_id, the least first."""
    facts = records.select("record_id", F.col("normalized_name").alias("record_name"), "display_name", is_active().alias("active"), F.coalesce("registry_number", F.lit(0)).alias("number"))
    standing = F.struct((-F.col("score")).alias("score"), (~F.col("active")).alias("excluded"), (-F.col("number")).alias("number"), "record_id")
    return scores.join(facts, "record_id").withColumn("standing", standing)


def placed_scores(scores: DataFrame, records: DataFrame) -> DataFrame:
    """Scored pairs with their place by standing."""
    return with_standing(scores, records).withColumn("place", F.row_number().over(Window.partitionBy("cache_key").orderBy("standing"))).drop("standing")


def decide(rows: DataFrame, threshold: float, margin: float) -> DataFrame:
    """One row for each entity whose best record reaches the threshold: tier, record_name, score, second, ambiguous and note.

    rows: from with_standing. The records of a name are one identity, of which the best counts; map-side minima leave one row for each
    entity and identity. The best of these and the best of another name then follow from one exchange, without ranking
    or joining back. An exact match counts as 0.99 at least; under that, another identity within the margin makes it ambiguous.
    """
    head = F.struct("standing", "record_name", "display_name", "tier")
    identities = rows.groupBy("cache_key", "record_name").agg(F.min(head).alias("head"))
    first = F.min("head").over(Window.partitionBy("cache_key"))
    other = F.when(F.col("record_name") != F.col("first.record_name"), F.col("head"))
    two = identities.withColumn("first", first).groupBy("cache_key").agg(F.min("first").alias("best"), F.min(other).alias("next"))
    raw, second = -F.col("best.standing.score"), F.coalesce(-F.col("next.standing.score"), F.lit(0.0))
    score = F.when(F.col("best.tier") == EXACT, F.greatest(raw, F.lit(0.99))).otherwise(raw)
    note = F.concat(F.lit(CLOSE_NOTE), quoted(F.col("best.display_name")), F.lit(" и "), F.coalesce(quoted(F.col("next.display_name")), F.lit("None")), F.lit("."))
    found = two.select("cache_key", "best.tier", "best.record_name", score.alias("score"), second.alias("second"), note.alias("note")).where(F.col("score") >= threshold)
    return found.withColumn("ambiguous", (F.col("score") < 0.99) & (F.col("score") - F.col("second") < margin))


def ranked(entities: DataFrame, records: DataFrame, pairs: DataFrame, threshold: float, margin: float) -> DataFrame:
    """Given pairs with their score and place."""
    return placed_scores(scored(entities, records, pairs, threshold, margin), records)


def short_names(entities: DataFrame, records: DataFrame) -> DataFrame:
    """cache_key and identities of entities whose short name alone fits records of several names: these are counted, no pairs made."""
    rest = entities.join(primary_pairs(entities, records), "cache_key", "left_anti")
    vague = exact_names(rest, records).where("low < high").select("cache_key")
    left = rest.join(vague, "cache_key", "left_semi").select("cache_key", entity_keys(sorted_names()))
    return pair_counts(left, records.select("normalized_name", record_keys(sorted_names()))).select("cache_key", F.col("n").alias("identities"))


def quoted(value: Column) -> Column:
    """A name in a note: in single quotes, in double ones if it holds single quotes only, what is special behind a backslash."""
    plain = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for mark, letter in (("\n", "n"), ("\r", "r"), ("\t", "t")):
        plain = F.replace(plain, F.lit(mark), F.lit(f"\\{letter}"))
    double = F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))


def lookup(entities: DataFrame, records: DataFrame, threshold: float = 0.84, margin: float = 0.04) -> DataFrame:
    """One row for each entity that finds something: score, ambiguous, notes and the selected records in order.

    entities: cache_key, normalized_name, entity_type, search_names; cache_key unique. record_id is the last tie-break.
    """
    # Names and pairs are used several times below: they are settled once. Exact pairs are not: a given name alone can have as many as rows times rows.
    entities = cut(entities.select("cache_key", "normalized_name", "entity_type", "search_names"))
    records = cut(records.select("record_id", "registry_number", "display_name", "normalized_name", "search_names", "entity_type", "date_excluded", "links"))
    by_key = Window.partitionBy("cache_key")
    exact = cut(exact_names(entities, records))
    # Records of the very name, where there are any, are the only candidates; else those of the only name that fits.
    primary = cut(primary_pairs(entities, records))
    others = exact.join(primary, "cache_key", "left_anti")
    short = others.where("low < high").select("cache_key")
    wanted = others.where("low = high").join(entities, "cache_key").select("cache_key", F.col("low").alias("record_name"), entity_keys(sorted_names()))
    clear = cut(primary.unionByName(named_pairs(wanted, records)))
    rest = entities.join(exact, "cache_key", "left_anti")
    sure = best_scores(name_rows(entities, records, clear.withColumn("tier", F.lit(EXACT))), threshold, margin)
    rows = with_standing(cut(sure.unionByName(near_scores(rest, records, threshold, margin))), records)
    decided = decide(rows, threshold, margin)

    # The whole identity of the best record: every candidate of its name, also those that the bound left unscored. Records of one
    # name share its tokens, so each of them that fits in type is a fuzzy candidate if one is.
    facts = records.select("record_id", F.col("normalized_name").alias("record_name"), F.col("entity_type").alias("record_type"), "registry_number", "display_name", "date_excluded", "links")
    best_names = decided.where("NOT ambiguous").select("cache_key", "tier", "record_name").join(entities.select("cache_key", "entity_type"), "cache_key")
    identity = best_names.join(facts, "record_name").where(type_fits(F.col("entity_type"), F.col("record_type"))).drop("entity_type", "record_type")
    identity = identity.where(F.col("tier") == FUZZY).unionByName(identity.where(F.col("tier") == EXACT).join(clear, ["cache_key", "record_id"], "left_semi"))
    placed = identity.join(rows.select("cache_key", "record_id", "standing"), ["cache_key", "record_id"], "left")
    number, active = F.coalesce("registry_number", F.lit(0)), is_active()
    placed = placed.withColumn("any_active", F.max(active).over(by_key)).withColumn("newest", F.max(number).over(by_key))
    chosen = placed.where(F.when(F.col("any_active"), active).otherwise(number == F.col("newest")))
    # Those that the bound left unscored come last.
    place = F.struct(F.col("standing").isNull().alias("far"), F.col("standing").alias("standing"))
    selected = chosen.groupBy("cache_key").agg(
        F.array_sort(F.collect_list(F.struct(place.alias("place"), "record_id", "registry_number", "display_name", active.alias("active"), "links"))).alias("records")
    )
    matched = decided.join(selected, "cache_key", "left").select("cache_key", F.col("score").alias("match_score"), "ambiguous", F.when(F.col("ambiguous"), F.array("note")).otherwise(F.array().cast("array<string>")).alias("ambiguity_notes"), "records")
    vague = short.select("cache_key", F.lit(0.99).alias("match_score"), F.lit(True).alias("ambiguous"), F.array(F.lit(SHORT_NAME_NOTE)).alias("ambiguity_notes"), F.lit(None).alias("records"))
    empty = F.array().cast(selected.schema["records"].dataType)
    return matched.unionByName(vague).withColumn("records", F.coalesce(F.col("records").cast(selected.schema["records"].dataType), empty))
