"""Fingerprints of files and of sets of files.

A file's fingerprint covers size, device, inode and modification time. A set's fingerprint has to
be independent of row order, mergeable from partial aggregates (so that a batch holding a third of
all files is still hashed map-side) and updatable when one member changes. It is therefore an
additive multiset hash: every member's SHA-256 is cut into words, the words are summed per set, and
the sums with the member count are hashed once more. A word has 24 bits, so a 64-bit sum is exact
up to 2**39 members.
"""

from pyspark.sql import Column, functions as F

WORDS = tuple(f"fp_{i}" for i in range(6))
_HEX_PER_WORD = 6


def file_fingerprint(size: Column, dev: Column, ino: Column, mtime: Column) -> Column:
    """SHA-256 over the four stat fields, each followed by ``|``."""
    fields = [size, dev, ino, F.unix_micros(mtime.cast("timestamp"))]
    texts = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return F.sha2(F.concat(F.concat_ws("|", *texts), F.lit("|")), 256)


def file_fingerprint_blake2s() -> object:
    """An Arrow UDF giving the BLAKE2s digest of the same fields, for byte parity with old catalogs.

    BLAKE2s is not a Spark built-in, so this one leaves the JVM; the modification time is hashed
    as decimal epoch seconds.
    """
    import pandas as pd
    from hashlib import blake2s

    @F.pandas_udf("string")
    def digest(size: pd.Series, dev: pd.Series, ino: pd.Series, mtime: pd.Series) -> pd.Series:
        seconds = mtime.astype("float64")
        return pd.Series([
            blake2s(f"{a}|{b}|{c}|{d}|".encode()).hexdigest()
            for a, b, c, d in zip(size, dev, ino, seconds.tolist())
        ])

    return lambda size, dev, ino, mtime: digest(size, dev, ino, F.unix_micros(mtime) / F.lit(1e6))


def _words(fingerprint):
    """The words, of which two at a time are read from the digits."""
    bits, words = 4 * _HEX_PER_WORD, []
    for start in range(1, len(WORDS) * _HEX_PER_WORD, 2 * _HEX_PER_WORD):
        two = F.conv(F.substring(fingerprint, start, 2 * _HEX_PER_WORD), 16, 10).cast("long")
        words += [F.shiftright(two, bits), two.bitwiseAND(F.lit(2**bits - 1))]
    return words


def fingerprint_words(fingerprint: Column, sign: Column | None = None) -> list[Column]:
    """The member's words, aliased; ``sign`` of -1 takes a member out of a set."""
    words = _words(fingerprint)
    if sign is not None:
        words = [w * sign for w in words]
    return [w.alias(name) for w, name in zip(words, WORDS)]


def sum_words(fingerprint: Column) -> list[Column]:
    """Aggregates that accumulate members' words."""
    return [F.sum(w).alias(name) for w, name in zip(_words(fingerprint), WORDS)]


def merge_words() -> list[Column]:
    """Aggregates that merge already accumulated words."""
    return [F.sum(name).alias(name) for name in WORDS]


def set_fingerprint(count: Column) -> Column:
    """The final digest from accumulated words and the member count."""
    return F.sha2(F.concat_ws("|", count.cast("string"), *[F.col(w).cast("string") for w in WORDS]), 256)
