"""Hashes of any number of bits (F3, F4, J6 beyond 64 bits).

A wide hash is an ``array<bigint>`` of 64-bit words that read as one big unsigned number: the first word holds
the top ``bits mod 64`` bits (or 64), the others 64 each; a hash's first bit is its top bit. Its text is
that number as ``ceil(bits / 4)`` hex digits. Everything is column arithmetic on words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 64


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(bits: int) -> int:
    return -(-bits // WORD)


def pack_bits(bits: Column, n: int) -> Column:
    """array<boolean> of ``n`` bits, first bit on top -> words. Another number of bits is an error."""
    head = n - (word_count(n) - 1) * WORD

    def word(a: int, size: int) -> Column:
        return F.aggregate(F.slice(bits, a + 1, size), F.lit(0).cast("long"),
                           lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(F.when(b, F.lit(1)).otherwise(F.lit(0)).cast("long")))

    words = [word(0, head)] + [word(head + i * WORD, WORD) for i in range(word_count(n) - 1)]
    return F.when(F.size(bits) == n, F.array(*words)).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {n} bits, got "), F.size(bits).cast("string"))).cast("array<bigint>"))


def unpack_bits(words: Column | str, n: int) -> Column:
    """Words -> array<boolean> of ``n`` bits, first bit on top."""
    w = _c(words)
    pad = word_count(n) * WORD - n
    return F.transform(F.sequence(F.lit(pad), F.lit(pad + n - 1)), lambda i: F.call_function(
        "shiftright", F.get(w, (i / WORD).cast("int")), (F.lit(WORD - 1) - i % WORD).cast("int")).bitwiseAND(F.lit(1)) == 1)


def hamming_words(a: Column | str, b: Column | str) -> Column:
    """number of differing bits of two wide hashes of one width; null if their widths differ."""
    diff = F.zip_with(_c(a), _c(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(diff, F.lit(0), lambda n, x: n + x).cast("int")


def wide_hex(words: Column | str, n: int) -> Column:
    """the hash as ceil(n / 4) lower-case hex digits."""
    digits = F.array_join(F.transform(_c(words), lambda x: F.lpad(F.hex(x), 16, "0")), "")
    return F.lower(F.right(digits, F.lit(-(-n // 4))))


def hex_wide(text: Column | str, n: int) -> Column:
    """hex digits (either case) -> words of an ``n``-bit hash; null for other text or a number that needs more bits.

    As the text is read as a number, it may be shorter than the hash: missing digits are zeros on top."""
    t = _c(text)
    full = F.lpad(t, word_count(n) * 16, "0")
    words = F.transform(F.sequence(F.lit(0), F.lit(word_count(n) - 1)), lambda i: F.conv(F.substring(full, i * 16 + 1, F.lit(16)), 16, -10).cast("long"))
    head = n - (word_count(n) - 1) * WORD
    fits = t.rlike(f"^[0-9a-fA-F]{{1,{word_count(n) * 16}}}$")
    if head < WORD:
        fits = fits & (F.shiftrightunsigned(F.get(words, F.lit(0)), head) == 0)
    return F.when(fits, words)


def square_bits(text: Column) -> Column:
    """bits of a text whose hash is a square: the side is floor(sqrt(4 * digits))."""
    side = F.floor(F.sqrt(F.length(text) * 4)).cast("int")
    return side * side


def multi_hex(hashes: Column, n: int) -> Column:
    """array of wide hashes -> their texts, joined by commas."""
    return F.array_join(F.transform(hashes, lambda h: wide_hex(h, n)), ",")


def hex_multi(text: Column | str, n: int) -> Column:
    """comma-joined texts -> array of wide hashes (null where a part is no hash)."""
    return F.transform(F.split(_c(text), ","), lambda t: hex_wide(t, n))


def old_hex_wide(text: Column | str, size: int = 8) -> Column:
    """F4, old byte order: size * (size // 4) digits; each pair of digits is eight bits, the lowest first.

    Gives words of size * (size // 4) * 4 bits; text of another length is an error."""
    digits = size * (size // 4)
    t = _c(text)
    byte = lambda i: F.conv(F.substring(t, (i / 8).cast("int") * 2 + 1, F.lit(2)), 16, 10).cast("int")
    bits = F.transform(F.sequence(F.lit(0), F.lit(digits * 4 - 1)), lambda i: F.call_function(
        "shiftright", byte(i), (i % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return F.when(F.length(t) == digits, pack_bits(bits, digits * 4)).otherwise(
        F.raise_error(F.lit(f"expected a hex string of {digits} digits")).cast("array<bigint>"))


def wide_old_hex(words: Column | str, n: int) -> Column:
    """the text in the old byte order of a hash of ``n`` bits (a multiple of 8)."""
    bits = unpack_bits(words, n)
    byte = lambda k: F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0), lambda v, i: v + F.when(
        F.get(bits, k * 8 + i), F.call_function("shiftleft", F.lit(1), i)).otherwise(0))
    return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n // 8 - 1)), lambda k: F.lpad(F.hex(byte(k)), 2, "0")), ""))


# ------------------------------------------------------------------- bands
def wide_bands(bits: int, bands: int) -> list[tuple[int, int]]:
    """(offset from the top bit, width) of ``bands`` disjoint bands that cover the hash."""
    base, extra = divmod(bits, bands)
    out, at = [], 0
    for i in range(bands):
        size = base + (1 if i < extra else 0)
        out.append((at, size))
        at += size
    return out


def bit_range(words: Column, n: int, at: int, size: int) -> Column:
    """Bits at..at+size-1 from the top of an ``n``-bit hash as an unsigned number; size < 64. The range may cross words."""
    low = n - at - size  # bits below the range
    k = word_count(n) - 1 - low // WORD
    shift = low % WORD
    part = F.shiftrightunsigned(F.get(words, F.lit(k)), shift)
    if shift + size > WORD:
        part = part.bitwiseOR(F.shiftleft(F.get(words, F.lit(k - 1)), WORD - shift))
    return part.bitwiseAND(F.lit((1 << size) - 1))


def band_values(words: Column, n: int, layout: list[tuple[int, int]]) -> Column:
    """array<array<bigint>>: every band's bits, in numbers of at most 62 bits."""
    def value(at: int, size: int) -> Column:
        return F.array(*[bit_range(words, n, at + a, min(62, size - a)) for a in range(0, size, 62)])

    return F.array(*[value(at, size) for at, size in layout])


def band_distances(a: Column, b: Column, n: int, layout: list[tuple[int, int]]) -> list[Column]:
    """Differing bits of two hashes in each band."""
    def part(at: int, size: int) -> Column:
        out = F.lit(0)
        for k in range(0, size, 62):
            m = min(62, size - k)
            out = out + F.bit_count(bit_range(a, n, at + k, m).bitwiseXOR(bit_range(b, n, at + k, m)))
        return out

    return [part(at, size) for at, size in layout]


def probes(value: Column, size: int, radius: int) -> Column:
    """Every value of a band that differs from ``value`` in at most ``radius`` (0, 1 or 2) of its ``size`` bits."""
    if radius not in (0, 1, 2):
        raise ValueError("a band is probed up to two bits away; take more bands")
    flips: list[list[int]] = [[]]
    if radius >= 1:
        flips += [[i] for i in range(size)]
    if radius >= 2:
        flips += [[i, j] for i in range(size) for j in range(i)]

    def mask(flip: list[int]) -> list[int]:
        out = [0] * -(-size // 62)
        for i in flip:
            out[i // 62] |= 1 << (i % 62)
        return out

    masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in mask(f)]) for f in flips])
    return F.transform(masks, lambda m: F.zip_with(value, m, lambda x, y: x.bitwiseXOR(y)))
