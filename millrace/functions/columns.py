"""Scalar operators as built-in expressions: Column in, Column out.

All of them stay inside Catalyst (no Python on the executors), except
:func:`fold_ascii` and :func:`join_url`, for which Spark has no function; these
two are Arrow UDFs.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ontology as O

lit, col = F.lit, F.col


# paths


def parts(path: Column) -> Column:
    return F.split(path, "/")


def name_of(path: Column) -> Column:
    return F.element_at(parts(path), -1)


def extension(name: Column) -> Column:
    """Lower-case extension with its dot; names that begin with their only dot have none."""
    return F.lower(F.regexp_extract(name, r".(\.[^.]*)$", 1))


def stem(name: Column) -> Column:
    return F.substring(name, lit(1), F.char_length(name) - F.char_length(extension(name)))


def is_image(name: Column, exts: tuple[str, ...] = O.EXTS_ALL) -> Column:
    return extension(name).isin(*["." + e for e in exts])


def class_of(path: Column) -> Column:
    """The folder that a file is in."""
    return F.try_element_at(parts(path), lit(-2))


def source_of(name: Column, root: Column) -> Column:
    """The first known tag, in their order, that the file name has; else the root."""
    found = [F.when(F.contains(name, lit(f"__{t}__")), lit(t)) for t in O.SOURCE_TAGS]
    return F.coalesce(*found, root)


def scope_key(rel: Column, scope: str) -> Column:
    """What near-duplicates are looked for within: ``dir``, ``class`` (first folder) or ``root``."""
    if scope == "root":
        return lit("")
    p = parts(rel)
    return F.array_join(F.slice(p, 1, F.size(p) - 1), "/") if scope == "dir" else p[0]


def restored_path(rel: Column) -> Column:
    """A path without the trash folders in it."""
    return F.array_join(F.filter(parts(rel), lambda s: ~((s == ".trash") | s.startswith("blur_") | s.startswith("dupe_") | s.startswith("small_"))), "/")


# class names


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[lit(x) for kv in table.items() for x in kv])


def normal_class(raw: Column) -> Column:
    """The name of a ``Crop___Disease`` class; names without ``___`` stay."""
    crop, rest = F.substring_index(raw, "___", 1), F.substring(raw, F.instr(raw, "___") + 3, F.char_length(raw))
    for a, b in (("(maize)", ""), ("Corn_", "Corn"), ("Corn ", "Corn")):
        crop = F.replace(crop, lit(a), lit(b))
    crop = F.btrim(crop, lit(" _"))
    for a, b in (("Pepper,_bell", "Bell_pepper"), ("Cherry_(including_sour)", "Cherry")):
        crop = F.replace(crop, lit(a), lit(b))
    crop = F.replace(F.when(crop == "Grape", lit("grape")).otherwise(crop), lit("Soybean"), lit("Soyabean"))
    disease = F.btrim(F.replace(F.replace(rest, lit("_"), lit(" ")), lit("  "), lit(" ")), lit(" _"))
    low = F.lower(disease)
    rules = F.when(low == "healthy", F.concat(F.when(F.lower(crop) == "grape", lit("grape")).otherwise(crop), lit(" leaf")))
    for of, words, name in O.DISEASE_RULES:
        is_crop = crop.startswith(of[:-1]) if of.endswith("*") else F.lower(crop) == of if of == "grape" else crop == of
        rules = rules.when(reduce(lambda a, w: a & F.contains(low, lit(w)), words, is_crop), lit(name))
    plain = F.trim(F.concat_ws(" ", crop, disease))
    plain = F.when(F.contains(F.lower(plain), lit("leaf")), plain).otherwise(F.concat(plain, lit(" leaf")))
    rules = rules.otherwise(F.trim(F.regexp_replace(plain, r"\s+", " ")))
    return F.when(F.contains(raw, lit("___")), rules).otherwise(raw)


def crop_of(klass: Column, root: Column) -> Column:
    return F.when(root == "diseases", F.split(klass, " ")[0]).when(root == "crops", klass)


def crop_zh(crop: Column) -> Column:
    m = _lookup(O.CROP_ZH)
    return F.coalesce(F.try_element_at(m, crop), F.try_element_at(m, F.lower(crop)), crop)


def has_disease_token(klass: Column) -> Column:
    return reduce(lambda a, t: a | F.contains(F.lower(klass), lit(t)), O.DISEASE_TOKENS[1:], F.contains(F.lower(klass), lit(O.DISEASE_TOKENS[0])))


def is_healthy(klass: Column) -> Column:
    return F.lower(F.trim(klass)).endswith("leaf") & ~has_disease_token(klass)


def disease_of(klass: Column) -> Column:
    return F.when(has_disease_token(klass), klass)


def source_class(name: Column) -> Column:
    """Trimmed, without one trailing " plant", accents folded, blanks squeezed."""
    t = F.trim(name)
    t = F.when(F.lower(t).endswith(" plant"), F.substring(t, lit(1), F.char_length(t) - 6)).otherwise(t)
    return F.trim(F.regexp_replace(fold_ascii(t), r"\s+", " "))


def folder_name(name: Column) -> Column:
    return F.trim(F.translate(name, "/\\", "--"))


@F.pandas_udf(T.StringType())
def fold_ascii(s: pd.Series) -> pd.Series:
    """NFKD without what isn't ASCII."""
    return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


# names and ids

#: Fixed value: the URL name space of version-5 UUIDs.
URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5_hex(name: Column) -> Column:
    """Hex of a name-based (SHA-1) UUID in the URL name space."""
    h = F.sha1(F.concat(F.unhex(lit(URL_SPACE)), F.to_binary(name, lit("utf-8"))))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 12), lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))


def stable_name(klass: Column, rel: Column) -> Column:
    """``<class>__cd__<uuid><ext>``, the same on every run."""
    token = F.trim(F.replace(klass, lit("/"), lit("-")))
    ext = extension(name_of(rel))
    ext = F.when(ext.isin(*["." + e for e in O.EXTS_NO_GIF]), ext).otherwise(lit(".jpg"))
    return F.concat(token, lit("__cd__"), uuid5_hex(F.concat(lit("crop-diseases::"), token, lit("::"), rel)), ext)


def tagged_name(klass: Column, tag: str, key: Column, name: Column) -> Column:
    """``<class>__<tag>__<id><ext>``; ``key`` gives the id, so that a re-run makes the same names."""
    return F.concat(folder_name(klass), lit(f"__{tag}__"), uuid5_hex(key), extension(name))


def new_name(mode: Column, name: Column, custom: Column, klass: Column, tag: str, key: Column) -> Column:
    """By mode: ``keep``, ``custom`` (null if it is empty or has separators), or else an id."""
    plain = (custom != "") & ~custom.rlike(r"[/\\]")
    return F.when(mode == "keep", name).when(mode == "custom", F.when(plain, custom)).otherwise(tagged_name(klass, tag, key, name))


def valid_target(target: Column) -> Column:
    """The trimmed target class; null if it is empty or has path separators."""
    t = F.trim(target)
    return F.when((t != "") & ~t.rlike(r"[/\\]"), t)


def path_error(path: Column, exists: Column, roots: list[str], exts: tuple[str, ...] = O.EXTS_NO_GIF) -> Column:
    """404, 403 or 400 for a path that isn't there, under no root, or no image; else null."""
    under = reduce(lambda a, r: a | path.startswith(r.rstrip("/") + "/"), roots, lit(False))
    return F.when(~exists, lit(404)).when(~under, lit(403)).when(~is_image(name_of(path), exts), lit(400))


def matched_root(path: Column, roots: list[str]) -> Column:
    return F.coalesce(*[F.when(path.startswith(r.rstrip("/") + "/"), lit(r)) for r in roots])


def component(value: Column, fallback: str) -> Column:
    """Letters, digits, blanks, ``_`` and ``-`` of a value, as a folder name."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(value, r"[^\p{L}\p{N} _-]", "")), lit("")), lit(fallback))


def reject_folder(actual: Column, expected: Column) -> Column:
    clean = F.regexp_replace(F.rtrim(F.regexp_replace(F.lower(F.trim(actual)), r"[^\p{L}\p{N} _]", "")), " ", "_")
    return F.when(F.trim(actual) != "", clean).otherwise(expected)


def manifest_fields(rel: Column, folder: str = "") -> dict[str, Column]:
    """keyword, source, in_trash and trash_reason of a path below the scrape folder, which is called ``folder``."""
    p = parts(rel)
    n = F.size(p)
    trash = p[0] == ".trash"
    third = F.try_element_at(p, lit(-3))
    keyword = F.when(trash, F.when((n >= 3) & (third != ".trash"), third).otherwise(lit("__trash__"))).otherwise(p[0])
    source = F.when(trash & (n < 2), lit("")).otherwise(F.coalesce(F.try_element_at(p, lit(-2)), lit(folder)))
    mid = F.filter(F.slice(p, 2, F.greatest(n - 3, lit(0))), lambda s: (s != "") & (s != ".trash"))
    mid = F.when((F.size(mid) > 0) & (F.try_element_at(mid, lit(-1)) == keyword), F.slice(mid, 1, F.greatest(F.size(mid) - 1, lit(0)))).otherwise(mid)
    return {"keyword": keyword, "source": source, "in_trash": trash, "trash_reason": F.when(trash & (n > 3) & (F.size(mid) > 0), F.array_join(mid, "/"))}


# text and URLs


def squeeze(text: Column) -> Column:
    """Blanks (Unicode's) squeezed and trimmed; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), lit(""))


def first_filled(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, lit("")) for v in values])


def quote_plus(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), lit("%7E"), lit("~")), lit("*"), lit("%2A"))


def query_string(params: dict[str, Column]) -> Column:
    return F.concat_ws("&", *[F.concat(lit(k + "="), quote_plus(v.cast("string"))) for k, v in params.items()])


def host(url: Column) -> Column:
    """The authority of a URL, port and user included."""
    return F.coalesce(F.try_parse_url(url, lit("AUTHORITY")), lit(""))


@F.pandas_udf(T.StringType())
def join_url(base: pd.Series, link: pd.Series) -> pd.Series:
    from urllib.parse import urljoin

    return pd.Series([None if b is None or x is None else urljoin(b, x) for b, x in zip(base, link, strict=True)])


def page_size(conf: Column, least: int = 10, most: int = 100, default: int = 35) -> Column:
    return F.greatest(lit(least), F.least(lit(most), F.coalesce(conf.try_cast("int"), lit(default))))


def most_pages(conf: Column) -> Column:
    return F.greatest(lit(1), F.coalesce(conf.try_cast("int"), lit(1)))


def needed_pages(conf: Column, results: Column, per_page: Column) -> Column:
    return F.least(conf, F.ceil(results / per_page).cast("int"))


def large_photo(url: Column) -> Column:
    return F.replace(url, lit("square"), lit("large"))


def commons_page(title: Column) -> Column:
    return F.concat(lit("https://commons.wikimedia.org/wiki/"), F.replace(title, lit(" "), lit("_")))


# hashes and verdicts


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def is_blurred(method: str, laplacian: Column, tenengrad: Column, lap_limit: float, ten_limit: float) -> Column:
    """A metric that could not be computed counts as sharp."""
    lap = F.coalesce(laplacian, lit(lap_limit)) < lap_limit
    ten = F.coalesce(tenengrad, lit(ten_limit)) < ten_limit
    return {"laplacian": lap, "tenengrad": ten, "both": lap & ten}[method]


def is_small(w: Column, h: Column, least_w: int, least_h: int) -> Column:
    return (w < least_w) | (h < least_h)


def leaf_2020(healthy: Column, rust: Column, scab: Column) -> Column:
    return F.when(rust == "1", lit("Apple rust leaf")).when(scab == "1", lit("Apple Scab Leaf")).otherwise(lit("Apple leaf"))


def leaf_2021(labels: Column) -> Column:
    """Class and health of a blank-separated label list: struct(class, healthy, disease, multi_labels)."""
    many = F.filter(F.split(F.trim(labels), r"\s+"), lambda x: x != "")
    kinds = F.array_distinct(many)
    healthy = F.array_contains(many, "healthy")
    name = F.when(~healthy & (kinds == F.array(lit("rust"))), lit("Apple rust leaf")).when(~healthy & (kinds == F.array(lit("scab"))), lit("Apple Scab Leaf"))
    return F.struct(F.coalesce(name, lit("Apple leaf")).alias("class"), (healthy & (F.size(many) == 1)).alias("healthy"), name.alias("disease"), many.alias("multi_labels"))


def status_zh(status: Column) -> Column:
    return F.when(status == "accepted", lit("已通过")).when(status == "rejected", lit("已剔除")).otherwise(lit("待审核"))


def reason_text(reason: Column) -> Column:
    return F.coalesce(F.nullif(F.replace(F.replace(reason, lit(".trash/"), lit(" / ")), lit("_"), lit(" ")), lit("")), lit("未标记"))


#: Fixed value: stands for a trash reason that isn't known.
NO_REASON = "__none__"


def selection_code(in_trash: Column, keyword: Column, reason: Column) -> Column:
    """``class|keyword`` or ``trash|keyword|reason``."""
    return F.when(in_trash, F.concat_ws("|", lit("trash"), keyword, F.coalesce(F.nullif(reason, lit("")), lit(NO_REASON)))).otherwise(F.concat_ws("|", lit("class"), keyword))


def selection_of(code: Column) -> Column:
    """What a selection's code says: struct(type, keyword, reason); null for none."""
    p = F.split(code, r"\|")
    kind = p[0]
    reason = F.when(kind == "trash", F.coalesce(F.nullif(F.get(p, lit(2)), lit("")), lit(NO_REASON)))
    return F.when(kind.isin("class", "trash"), F.struct(kind.alias("type"), F.get(p, lit(1)).alias("keyword"), reason.alias("reason")))


def shown_keyword(keyword: Column) -> Column:
    return F.coalesce(F.nullif(keyword, lit("")), lit("(未标注)"))


def stamp(time: Column) -> Column:
    """``yyyyMMdd_HHmmss``, as trash folders carry it."""
    return F.date_format(time, "yyyyMMdd_HHmmss")


def iso_stamp(time: Column) -> Column:
    """ISO 8601 to the second, in UTC."""
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_millis(time: Column) -> Column:
    """Milliseconds since 1970, as review states carry them."""
    return F.unix_millis(time)
