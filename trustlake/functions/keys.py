"""Public keys as people write them: hexadecimal digits or checked base-32 words, read and written as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the published format: the 32 letters by value, and the checksum's generator.
LETTERS = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
PREFIX = "npub"
#: Words of profiles: their prefix, and the longest word that is read.
PROFILE, LONGEST = "nprofile", 5000


def _expanded(prefix: str) -> list[int]:
    return [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def checksum(values: Column, prefix: str = PREFIX) -> Column:
    """The remainder over GF(32) of a prefix and values (longs); 1 for a word with a right checksum."""

    def step(rest: Column, v: Column) -> Column:
        out = F.shiftleft(rest.bitwiseAND(_long(0x1FFFFFF)), 5).bitwiseXOR(v)
        for i, g in enumerate(GENERATOR):
            out = out.bitwiseXOR(F.when(F.shiftright(rest, 25 + i).bitwiseAND(_long(1)) == 1, _long(g)).otherwise(_long(0)))
        return out

    head = F.array(*map(_long, _expanded(prefix)))
    return F.aggregate(F.concat(head, values), _long(1), step)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _regrouped(values: Column, n: int | Column, bits: int, into: int) -> Column:
    """``n`` numbers of ``into`` bits out of numbers of ``bits`` bits, bit after bit; missing ones at the end are zero."""
    zero = _long(0)

    def number(i: Column) -> Column:
        out = zero
        for b in range(into):
            at = i * into + b
            bit = F.coalesce(F.get(values, F.floor(at / bits).cast("int")), zero)
            out = F.shiftleft(out, 1).bitwiseOR(F.expr("0L") + F.call_function("getbit", bit, (F.lit(bits - 1) - at % bits).cast("int")))
        return out

    last = F.lit(n - 1) if isinstance(n, int) else n - 1
    return F.transform(F.sequence(F.lit(0), last.cast("int")), number)


def word_key(text: Column, prefix: str = PREFIX) -> Column:
    """The 64 hexadecimal digits of a key in a checked base-32 word, null for anything else.

    A word is lower case or upper case as a whole, has the prefix, the digit 1, 52 letters and six of checksum; the four
    bits that 52 letters have more than a key are zero.
    """

    def read(text: Column) -> Column:
        word = F.lower(text)
        shape = word.rlike(f"^{prefix}1[{LETTERS}]{{58}}$") & ((text == word) | (text == F.upper(text)))
        letters = F.split(F.substring(word, len(prefix) + 2, 58), "")
        values = F.transform(letters, lambda c: (F.instr(F.lit(LETTERS), c) - 1).cast("long"))
        return F.when(shape, _bound(values, key_of))

    def key_of(values: Column) -> Column:
        digits = F.transform(_regrouped(values, 64, 5, 4), lambda v: F.lower(F.hex(v)))
        unused = F.element_at(values, 52).bitwiseAND(_long(15)) == 0
        return F.when((checksum(values, prefix) == 1) & unused, F.array_join(digits, ""))

    return _bound(text, read)


def profile_key(text: Column) -> Column:
    """The key that a profile's word names, as 64 hexadecimal digits; null for anything else.

    A profile is a list of records, each a type, a length and so many bytes; the first record of type 0 is the key and
    has 32 bytes. Hints of relays and records of other types, before or after it, are passed over. A profile without a
    key, with a record that is cut off before it, or with a wrong checksum is none.
    """
    head = len(PROFILE) + 1

    def read(text: Column) -> Column:
        word = F.lower(text)
        shape = word.rlike(f"^{PROFILE}1[{LETTERS}]{{60,}}$") & (F.length(word) <= LONGEST) & ((text == word) | (text == F.upper(text)))
        letters = F.split(F.substring(word, head + 1, LONGEST), "")
        values = F.transform(letters, lambda c: (F.instr(F.lit(LETTERS), c) - 1).cast("long"))
        return F.when(shape, _bound(values, lambda v: F.when(checksum(v, PROFILE) == 1, records_of(v))))

    def records_of(values: Column) -> Column:
        return _bound(_regrouped(values, F.floor((F.size(values) - 6) * 5 / 8), 5, 8), first_key)

    def first_key(data: Column) -> Column:
        # one step for each byte; a record is looked at where the one before it ends
        begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit(-1).alias("key"))

        def step(state: Column, i: Column) -> Column:
            here = (state["at"] == i) & (state["key"] < 0)
            found = here & (F.get(data, i) == 0)
            size = F.coalesce(F.get(data, i + 1), _long(0))
            return F.struct(F.when(here, i + 2 + size).otherwise(state["at"]).cast("long").alias("at"), F.when(found, i).otherwise(state["key"]).cast("int").alias("key"))

        at = F.aggregate(F.sequence(F.lit(0), F.size(data) - 1), begin, step, lambda s: s["key"])
        return _bound(at, lambda k: F.when((k >= 0) & (F.get(data, k + 1) == 32) & (k + 34 <= F.size(data)), F.lower(F.array_join(F.transform(F.slice(data, k + 3, F.lit(32)), lambda b: F.lpad(F.hex(b), 2, "0")), ""))))

    return _bound(text, read)


def _word(prefix: str, data: Column) -> Column:
    """The word of a prefix and numbers of five bits, with its checksum."""

    def checked(data: Column) -> Column:
        rest = checksum(F.concat(data, F.array(*[_long(0)] * 6)), prefix).bitwiseXOR(_long(1))
        tail = _bound(rest, lambda r: F.array(*[F.shiftright(r, 5 * (5 - i)).bitwiseAND(_long(31)) for i in range(6)]))
        letters = F.transform(F.concat(data, tail), lambda v: F.substring(F.lit(LETTERS), (v + 1).cast("int"), F.lit(1)))
        return F.concat(F.lit(f"{prefix}1"), F.array_join(letters, ""))

    return _bound(data, checked)


def _nibbles(text: Column) -> Column:
    return F.transform(F.split(text, ""), lambda c: F.conv(c, 16, 10).cast("long"))


def key_word(key: Column, prefix: str = PREFIX) -> Column:
    """A key of 64 hexadecimal digits as a checked base-32 word; null for anything else."""
    return F.when(key.rlike("^[0-9a-f]{64}$"), _bound(_nibbles(key), lambda v: _word(prefix, _regrouped(v, 52, 4, 5))))


def profile_word(records: Column) -> Column:
    """The word of a profile whose records are given as hexadecimal digits; null for anything else."""
    return F.when(records.rlike("^([0-9a-f]{2})+$"), _bound(_nibbles(records), lambda v: _word(PROFILE, _regrouped(v, F.ceil(F.size(v) * 4 / 5), 4, 5))))


def resolved_key(text: Column) -> Column:
    """A key of 64 hexadecimal digits in lower case from any form, spaces around it left out; null for anything else."""
    return _bound(F.trim(text), lambda t: F.when(t.rlike("^[0-9a-fA-F]{64}$"), F.lower(t)).when(F.lower(t).startswith(PROFILE), profile_key(t)).otherwise(word_key(t)))
