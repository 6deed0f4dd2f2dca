"""URL filter: rules by host and path, and a list of URLs behind a blocked Bloom filter.

Each listed canonical URL sets `BITS` bits in one block of `BLOCK` bits, which its hash chooses. The
filter is a table with a row for each block, made by one aggregation, and broadcast in parts of bounded size, each of
which the rows pass without a shuffle. What passes them goes to an exact join with the list, so false positives are
removed; the other rows take no part in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandscope.llm.columns import set_aside
from bandscope.session import BROADCAST_BYTES, broadcast_if_small, stored, weight

BLOCK, BITS = 256, 8
BITS_PER_URL = 16
# host and path, and what the rule says
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "(?s)://([^/?#]*)([^?#]*)([^#]*)"
TRACKING = r"(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def host(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading www., path without index page and last slash, query without tracking. Null without host."""
    name = F.regexp_replace(host(url), r"^www\.", "")
    place = F.regexp_replace(path(url), r"(/index\.html?)?/*$", "")
    query = F.regexp_replace(F.substring(F.regexp_extract(url, PARTS, 3), 2, 1 << 30), TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    return F.when(name != "", F.concat(name, place, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def masks(key: Column) -> list[Column]:
    """Four longs with the bits of a key inside its block."""
    draw = F.xxhash64(key, F.lit("bits"))
    places = [F.shiftrightunsigned(draw, 8 * i).bitwiseAND(F.lit(BLOCK - 1)) for i in range(BITS)]
    out = []
    for word in range(BLOCK // 64):
        bits = [
            F.when(F.shiftright(p, 6) == word, F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long"))
            for p in places
        ]
        out.append(reduce(lambda a, b: a.bitwiseOR(b), bits))
    return out


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w3) of the keys in the column `key`."""
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")
    words = listed.select(block, *(m.alias(f"w{i}") for i, m in enumerate(masks(F.col("key")))))
    return words.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK // 64)))


def in_list(urls: DataFrame, key: str, listed: DataFrame, flag: str = "listed", limit: int = BROADCAST_BYTES) -> DataFrame:
    """`urls` with a boolean column: whether the canonical URL in `key` is in the column `key` of `listed`. Null keys are not.

    A filter of more than `limit` bytes is broadcast in parts, one after another; the rows are written
    between them, so one part is held at a time.
    """
    keys = stored(listed.select("key").filter("key IS NOT NULL").distinct(), "listed")
    blocks = max(1, -(-keys.count() * BITS_PER_URL // BLOCK))
    table = stored(bloom(keys, blocks), "bloom")
    words = [f"w{i}" for i in range(BLOCK // 64)]
    rows, other = set_aside(urls, ("block", "listed", *words, "wanted", "block_no", "hit", flag))
    own = F.col(f"`{other.get(key, key)}`")
    rows = rows.withColumn("hit", F.lit(False))
    parts = max(1, -(-weight(table) // limit))
    for part in range(parts):
        some = F.broadcast(table.filter(F.pmod("block", F.lit(parts)) == part))
        probed = rows.withColumns({"wanted": F.array(*masks(own)), "block_no": F.pmod(F.xxhash64(own), F.lit(blocks))}).join(
            some, F.col("block_no") == F.col("block"), "left"
        )
        passes = (F.col(w).bitwiseAND(F.col("wanted")[i]) == F.col("wanted")[i] for i, w in enumerate(words))
        passed = F.coalesce(reduce(lambda a, b: a & b, passes, own.isNotNull()), F.lit(False))
        rows = probed.select(*(c for c in rows.columns if c != "hit"), (F.col("hit") | passed).alias("hit"))
        if part + 1 < parts:
            rows = stored(rows, "probed")
    # Only possible hits look for a partner.
    exact = broadcast_if_small(keys, limit).select(F.col("key").alias("listed"))
    found = rows.filter("hit").join(exact, own == F.col("listed"), "left").withColumn("hit", F.col("listed").isNotNull())
    answer = F.col("hit").alias(flag)
    columns = [*(F.col(f"`{other.get(c, c)}`").alias(c) for c in urls.columns if c != flag), answer]
    return found.select(*columns).unionAll(rows.filter("NOT hit").select(*columns))


def rule_for(name: Column, place: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one. The rules are a short list."""
    text, says = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((name == rule_host) | name.endswith("." + rule_host)) & place.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        says = F.when(fits, F.lit(verdict)).otherwise(says)
    return text, says


def judge_urls(rows: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, url: str = "url") -> DataFrame:
    """`rows` with host, path, rule and verdict; columns of these names before are replaced.

    A rule's verdict wins; without one a URL in the list (column `key`, canonical) is blocked, others are
    allowed. A null URL or one without :// has an empty host and path, fits no rule and is allowed. Every
    row is judged by itself, repeated ones alike.
    """
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in rows.columns if c not in added]
    text, says = rule_for(F.col("host"), F.col("path"), rules)
    plain, other = set_aside(rows.select(*(F.col(f"`{c}`") for c in kept)), ("canon", "on_list"))
    names = [other.get(c, c) for c in kept]
    own = F.col(f"`{other.get(url, url)}`")
    named = plain.select(*(F.col(f"`{c}`") for c in names), host(own).alias("host"), path(own).alias("path"), canonical(own).alias("canon"))
    flagged = in_list(named, "canon", listed, "on_list")
    verdict = F.coalesce(says, F.when(F.col("on_list"), "block").otherwise("allow"))
    return flagged.select(
        *(F.col(f"`{n}`").alias(c) for n, c in zip(names, kept, strict=True)), "host", "path", text.alias("rule"), verdict.alias("verdict")
    )
