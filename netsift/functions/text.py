"""String measures used on domain names and payload labels, all as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netsift.constants import (
    ENGLISH_BIGRAMS,
    ENGLISH_LETTERS,
    TLD_HIGH,
    TLD_LOW,
    TLD_MEDIUM,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _count_char(text: Column, char: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, char, F.lit("")))


def entropy(c: Column | str, lower: bool = False, digits: int | None = None) -> Column:
    """Shannon entropy in bits per character; 0 for the empty string, null for null."""
    text = F.lower(_col(c)) if lower else _col(c)
    size = F.nullif(F.length(text), F.lit(0)).cast("double")

    def step(acc: Column, char: Column) -> Column:
        p = _count_char(text, char) / size
        return acc - p * F.log2(p)

    bits = F.when(
        F.length(text) > 0,
        F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), step),
    ).when(text.isNotNull(), F.lit(0.0))
    return bits if digits is None else F.round(bits, digits)


def _entropy_part(part, lengths):
    """Entropies of some texts (no nulls): (text, code point) pairs are counted in tables of at most 4M cells."""
    import numpy as np

    points = np.frombuffer("".join(part).encode("utf-32-le"), "<u4")
    off = np.concatenate([[0], np.cumsum(lengths)])
    seen = np.bincount(points, minlength=0x110000) > 0
    dense = (np.cumsum(seen) - 1)[points]
    width = max(int(seen.sum()), 1)
    out = np.zeros(len(part))
    step = max(1, (1 << 22) // width)
    for at in range(0, len(part), step):
        stop = min(at + step, len(part))
        owner = np.repeat(np.arange(stop - at), lengths[at:stop])
        n = np.bincount(owner * width + dense[off[at]:off[stop]], minlength=(stop - at) * width)
        nz = np.flatnonzero(n)
        row = nz // width
        share = n[nz] / lengths[at:stop][row]
        out[at:stop] = -np.bincount(row, share * np.log2(share), stop - at)
    return out


def _text_entropy(texts):
    """Entropy per text of a pandas Series, in slices of about 1M code points."""
    import numpy as np
    import pandas as pd

    values = texts.to_numpy(dtype=object)
    present = np.flatnonzero(np.array([t is not None for t in values], bool))
    lengths = np.array([len(values[i]) for i in present], np.int64)
    out = np.full(len(values), np.nan)
    ends = np.searchsorted(np.cumsum(lengths), np.arange(1, (lengths.sum() >> 20) + 2) << 20, "right")
    at = 0
    for stop in [*ends.tolist(), len(present)]:
        stop = max(stop, min(at + 1, len(present)))
        if stop > at:
            out[present[at:stop]] = _entropy_part([values[i] for i in present[at:stop]], lengths[at:stop])
        at = stop
    return pd.Series(out)


def text_entropy(c: Column | str) -> Column:
    """``entropy`` of long texts: code points are counted once per text, not once per distinct character."""
    return F.pandas_udf(_text_entropy, "double")(_col(c))


def vowel_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(F.lower(_col(c)), "[^aeiou]", ""))


def consonant_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}]|[aeiou]", ""))


def consonant_share(c: Column | str) -> Column:
    """consonants / (vowels + consonants), 0 without letters."""
    return _share(consonant_count(c), vowel_count(c) + consonant_count(c))


def consonants_per_vowel(c: Column | str, digits: int | None = None) -> Column:
    """consonants / vowels; the consonant count itself where there is no vowel."""
    v, k = vowel_count(c), consonant_count(c)
    ratio = F.when(v == 0, k.cast("double")).otherwise(F.try_divide(k.cast("double"), v.cast("double")))
    return ratio if digits is None else F.round(ratio, digits)


def non_letter_bigram_share(c: Column | str) -> Column:
    """Share of adjacent character pairs that are not two letters; 1 below two characters."""
    text = F.lower(_col(c))
    pairs = F.length(text) - 1
    letter_pairs = F.regexp_count(text, F.lit(r"(?=\p{L}{2})"))
    return F.when(F.length(text) < 2, F.lit(1.0)).otherwise(
        F.try_divide((pairs - letter_pairs).cast("double"), pairs.cast("double")))


def english_bigram_mean(c: Column | str, digits: int | None = None) -> Column:
    """Mean English frequency over adjacent pairs; pairs outside the table count 0."""
    text = F.lower(_col(c))
    total = F.lit(0.0)
    for pair, freq in ENGLISH_BIGRAMS.items():
        total = total + _count_char(text, F.lit(pair)) / 2 * F.lit(freq)
    mean = F.when(F.length(text) < 2, F.lit(0.0)).otherwise(
        F.try_divide(total, (F.length(text) - 1).cast("double")))
    return mean if digits is None else F.round(mean, digits)


def class_ratio(c: Column | str, char_class: str) -> Column:
    """Share of characters inside a regex character class such as ``0-9``."""
    text = _col(c)
    return _share(F.length(F.regexp_replace(text, f"[^{char_class}]", "")), F.length(text))


def digit_ratio(c: Column | str) -> Column:
    return class_ratio(c, "0-9")


def hex_ratio(c: Column | str) -> Column:
    return class_ratio(F.lower(_col(c)), "0-9a-f")


def hyphen_ratio(c: Column | str) -> Column:
    return class_ratio(c, "-")


def vowel_ratio(c: Column | str) -> Column:
    return class_ratio(F.lower(_col(c)), "aeiou")


def letter_deviation(c: Column | str) -> Column:
    """Sum over a-z of |observed share - English share|; 0 without letters."""
    text = F.lower(_col(c))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    total = F.lit(0.0)
    for char, freq in ENGLISH_LETTERS.items():
        seen = F.try_divide(_count_char(text, F.lit(char)).cast("double"), letters.cast("double"))
        total = total + F.abs(seen - F.lit(freq))
    return F.when(letters > 0, total).otherwise(F.lit(0.0))


def labels(c: Column | str) -> Column:
    return F.split(_col(c), r"\.")


def first_label(c: Column | str) -> Column:
    """Text before the first dot."""
    return F.substring_index(_col(c), ".", 1)


def first_label_trimmed(c: Column | str) -> Column:
    """First label after dropping trailing dots."""
    return F.substring_index(F.rtrim(_col(c), F.lit(".")), ".", 1)


def subdomain(c: Column | str) -> Column:
    """All but the last two labels, empty when there are no more than two."""
    parts = labels(c)
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 1, F.size(parts) - 2), ".")).when(
        _col(c).isNotNull(), F.lit(""))


def base_domain(c: Column | str, single_is_null: bool = False) -> Column:
    """Last two labels; a lone label stays itself, or null with ``single_is_null``."""
    alone = F.lit(None).cast("string") if single_is_null else _col(c)
    return F.when(F.size(labels(c)) >= 2, F.substring_index(_col(c), ".", -2)).otherwise(alone)


def longest_run(c: Column | str) -> Column:
    """Length of the longest run of one repeated character, 0 if none repeats."""
    runs = F.regexp_extract_all(_col(c), F.lit(r"((.)\2+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def unique_ratio(c: Column | str) -> Column:
    text = _col(c)
    return F.when(F.length(text) > 0, F.size(F.array_distinct(F.split(text, ""))) / F.length(text)).otherwise(
        F.lit(0.0))


def has_digits(c: Column | str) -> Column:
    return _col(c).rlike("[0-9]").cast("int")


def has_hyphens(c: Column | str) -> Column:
    return F.contains(_col(c), F.lit("-")).cast("int")


def count_of(c: Column | str, char: str) -> Column:
    return _count_char(_col(c), F.lit(char))


def tld_risk(c: Column | str) -> Column:
    """1.0 high, 0.5 medium, 0.1 low, 0.7 unknown."""
    tld = F.lower(F.substring_index(_col(c), ".", -1))
    return (F.when(tld.isin(TLD_HIGH), 1.0).when(tld.isin(TLD_MEDIUM), 0.5)
            .when(tld.isin(TLD_LOW), 0.1).otherwise(0.7))


def base64_like(c: Column | str, min_chars: int = 20) -> Column:
    return _col(c).rlike("^[A-Za-z0-9+/]{%d,}={0,2}$" % min_chars)


def base64_text(c: Column | str) -> Column:
    """Standard base64 of a string's UTF-8 bytes in one line (Spark's own breaks it every 76 characters)."""
    return F.regexp_replace(F.base64(_col(c).cast("binary")), r"[\r\n]", "")


def base64_label(c: Column | str, min_chars: int = 40) -> Column:
    """True when the first label of a name looks like base64 data."""
    return _col(c).rlike(r"^[A-Za-z0-9+/]{%d,}=*\." % min_chars)


def decode_base64_label(c: Column | str, min_chars: int = 20) -> Column:
    """Decoded text of a base64-looking first label; null for anything else."""
    label = F.rtrim(first_label(c), F.lit("="))
    filled = F.rpad(label, (F.ceil(F.length(label) / 4) * 4).cast("int"), F.lit("="))
    raw = F.try_to_binary(filled, F.lit("base64"))
    return F.when(base64_like(label, min_chars) & (F.length(label) % 4 != 1), F.try_validate_utf8(raw.cast("string")))


def extension(c: Column | str) -> Column:
    """Lower-cased text after the last dot, empty without a dot."""
    return F.when(F.contains(_col(c), F.lit(".")), F.lower(F.substring_index(_col(c), ".", -1))).when(
        _col(c).isNotNull(), F.lit(""))


def cert_common_name(c: Column | str) -> Column:
    """Text between the first and second ``CN=`` of a subject, null without one."""
    return F.get(F.split(_col(c), "CN="), F.lit(1))


def uri_parts(c: Column | str) -> dict[str, Column]:
    """path, query, extension and fragment of a request target."""
    uri = _col(c)
    bare = F.regexp_extract(uri, r"^([^?#]*)", 1)
    query = F.regexp_extract(uri, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(uri, r"#(.*)$", 1)
    ext = F.regexp_extract(bare, r"\.([^./]+)$", 1)
    return {
        "path": bare,
        "query": F.nullif(query, F.lit("")),
        "extension": F.nullif(ext, F.lit("")),
        "fragment": F.nullif(fragment, F.lit("")),
    }


def full_url(domain: Column | str, path: Column | str) -> Column:
    """``http://`` + domain + path, null when either is null."""
    return F.concat(F.lit("http://"), _col(domain), _col(path))


def megabytes(c: Column | str, digits: int | None = None) -> Column:
    mb = _col(c) / F.lit(1048576.0)
    return mb if digits is None else F.round(mb, digits)
