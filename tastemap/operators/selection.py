"""Exact fractions of a table without sorting it: the cut is found in histograms of a hash.

Rows are ordered by a hash of their key. The hash's leading bits are counted, which tells in
which bin each cut falls; the bits after them are counted in those bins alone, and so on
until the cut is known to the row. Every pass reads the key column and brings back one
histogram of bounded size; no row is shuffled, and the fraction itself is a plain filter.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the hash, and those that one pass counts.
HASH_BITS, STEP = 62, 16


def hash_of(key: str) -> Column:
    """62 bits of the key's hash, 0 or above; NULL has one too."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(62), F.col(key)), 64 - HASH_BITS)


def select_cuts(df: DataFrame, ranks: list[int], hashed: Column, bits: int = HASH_BITS,
                step: int = STEP) -> list[tuple[int, int]]:
    """For each rank the hash of the row there, and how many rows of that hash to take.

    Rank r stands for the first r rows in the order of ``hashed``, of 0 to 2**bits - 1.
    ``bits / step`` passes at most, fewer if the bins of the cuts hold a row each.
    """
    found: dict[int, tuple[int, int]] = {}
    # Bin prefixes with the ranks that fall in them, counted from the bin's first row.
    open_bins: dict[int, list[tuple[int, int]]] = {0: [(r, r) for r in set(ranks)]}
    left = bits
    rows = df.select(hashed.alias("h"))
    while open_bins:
        taken = min(step, left)
        prefix = F.shiftright("h", left) if left < 64 else F.lit(0).cast("long")
        inside = rows if left == bits else rows.where(prefix.isin(*open_bins))
        counts = inside.groupBy(F.shiftright("h", left - taken).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("h").alias("least"), F.max("h").alias("most"))
        # At most 2**step bins for each open one.
        bins: dict[int, list] = {}
        for r in sorted(counts.collect(), key=lambda r: r.bin):
            bins.setdefault(r.bin >> taken, []).append(r)
        left -= taken
        still: dict[int, list[tuple[int, int]]] = {}
        for at, wanted in open_bins.items():
            for rank, inside_rank in wanted:
                before = 0
                for r in bins.get(at, []):
                    if inside_rank <= before + r.n:
                        if r.least == r.most:
                            found[rank] = r.least, inside_rank - before
                        else:
                            still.setdefault(r.bin, []).append((rank, inside_rank - before))
                        break
                    before += r.n
                else:
                    raise ValueError(f"there are fewer than {rank} rows")
        open_bins = still
    return [found[r] for r in ranks]


def take_selected_fractions(df: DataFrame, key: str, fractions: list[tuple[int, int]],
                            hashed: Column | None = None, bits: int = HASH_BITS) -> list[DataFrame]:
    """Exactly ``n * numerator // denominator`` rows for each fraction, smaller ones in larger.

    The rows are those of the least hashes of ``key``, the same whatever the partitioning.
    Where different keys share the hash at a cut, the smaller keys come first, NULL before
    all; rows of equal key at the cut cannot be told apart and are an error, so give a key that
    identifies a row.
    """
    hashed = hash_of(key) if hashed is None else hashed
    n = df.select(key).count()
    ranks = [n * a // b for a, b in fractions]
    inner = sorted({r for r in ranks if 0 < r < n})
    cuts = dict(zip(inner, select_cuts(df, inner, hashed, bits)))
    return [_first(df, key, rank, n, cuts, hashed) for rank in ranks]


def _first(df: DataFrame, key: str, rank: int, n: int, cuts: dict, hashed: Column) -> DataFrame:
    if rank <= 0:
        return df.where(F.lit(False))
    if rank >= n:
        return df
    cut, take = cuts[rank]
    # The keys that share the hash at the cut, nearly always one.
    at_cut = df.where(hashed == cut).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    keys = sorted(at_cut.collect(), key=lambda r: (r[0] is not None, r[0]))
    chosen = []
    for r in keys:
        if take <= 0:
            break
        if r.n > take:
            raise ValueError(f"{r.n} rows have {key} {r[0]}, which does not identify one")
        chosen.append(r[0])
        take -= r.n
    if len(chosen) == len(keys):
        return df.where(hashed <= cut)
    equal = F.lit(False)
    for value in chosen:
        equal = equal | F.col(key).eqNullSafe(F.lit(value))
    return df.where((hashed < cut) | (hashed == cut) & equal)
