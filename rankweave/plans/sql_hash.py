"""The tag hash written in SQL, for checking the column expressions against another engine."""

from __future__ import annotations

from rankweave.functions import byte_hash as bh
from rankweave.functions import tag_hash as th


def _wrap(x: str) -> str:
    return f"(xor(({x}) & 4294967295, 2147483648) - 2147483648)"


def _let(x: str, body: str) -> str:
    """`body` over the bound name `v`."""
    return f"list_transform([{x}], lambda v: {body})[1]"


def _factor(constant: int) -> int:
    return constant - (1 << 32) if constant >= 1 << 31 else constant


def sql_tag_hash(word: str, seed: int = th.DEFAULT_SEED) -> str:
    """SQL for the hash of a string of basic-plane characters."""
    scaled = _wrap(f"u * ({_factor(th.UNIT_FACTOR)})")
    mixed = f"({_wrap(f'{scaled} * 32768')} | (h >> 17))"
    turned = _let(f"xor(h, {_wrap(f'{mixed} * {th.MIX_FACTOR}')})", f"({_wrap('v * 8192')} | (v >> 19))")
    step = _wrap(f"{turned} * {th.STEP_FACTOR} + ({_factor(th.STEP_OFFSET)})")
    units = f"list_transform(list_filter(string_split({word}, ''), lambda ch: ch <> ''), lambda ch: CAST(unicode(ch) AS BIGINT))"
    state = f"list_reduce(list_prepend(CAST({seed} AS BIGINT), {units}), lambda h, u: {step})"
    state = f"xor({state}, length({word}))"
    state = _wrap(f"{_let(state, 'xor(v, v >> 16)')} * ({_factor(th.FINAL_FACTOR_1)})")
    state = _wrap(f"{_let(state, 'xor(v, v >> 13)')} * ({_factor(th.FINAL_FACTOR_2)})")
    return _let(state, "xor(v, v >> 16)")


_MASK = "18446744073709551615::UHUGEINT"


def _turned(x: str, bits: int, width: int = 64) -> str:
    mask = _MASK if width == 64 else "4294967295::UHUGEINT"
    return f"(((({x}) << {bits}) & {mask}) | (({x}) >> {width - bits}))"


def _times(x: str, factor: int, width: int = 64) -> str:
    mask = _MASK if width == 64 else "4294967295::UHUGEINT"
    return f"((({x}) * {factor}::UHUGEINT) & {mask})"


def _scrambled(k: str, first: int, bits: int, second: int, width: int = 64) -> str:
    return _let(_times(k, first, width), _times(_turned("v", bits, width), second, width))


def _number(first: str, count: int) -> str:
    """The little-endian number of `count` bytes after the first `first` ones."""
    return "(" + " + ".join(f"(codes[{first} + {j + 1}] << {8 * j})" for j in range(count)) + ")"


def _left_over(block: int, skip: int, count: int) -> str:
    """The number of the left-over bytes `skip` to `skip + count` behind the last full block; missing ones are 0."""
    parts = [f"CASE WHEN n % {block} > {skip + j} THEN codes[n // {block} * {block} + {skip + j + 1}] << {8 * j} ELSE 0::UHUGEINT END" for j in range(count)]
    return "(" + " + ".join(parts) + ")"


def _mixed_64(x: str) -> str:
    first, second = bh.FINAL_64
    once = _let(x, _times("xor(v, v >> 33)", first))
    return _let(_let(once, _times("xor(v, v >> 33)", second)), "xor(v, v >> 33)")


def _signed(x: str, width: int) -> str:
    kind = "BIGINT" if width == 64 else "INTEGER"
    return f"CAST(CASE WHEN {x} >= {1 << (width - 1)}::UHUGEINT THEN CAST({x} AS HUGEINT) - {1 << width}::HUGEINT ELSE CAST({x} AS HUGEINT) END AS {kind})"


def sql_byte_codes(text: str) -> str:
    """The UTF-8 bytes of a text as a list of UHUGEINT."""
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda d: CAST(CAST('0x' || d AS BIGINT) AS UHUGEINT))"


def sql_byte_hashes(source: str) -> str:
    """Table expressions over `source` (any columns, and codes): `byte_hashes` has h32, h64, h128_1 and h128_2 besides."""
    c1, c2, (five, add) = bh.C1_32, bh.C2_32, bh.STEP_32
    # Left-over bytes of the 32-bit hash have a sign.
    tail = [f"CASE WHEN n % 4 > {j} THEN CASE WHEN codes[n // 4 * 4 + {j + 1}] >= 128 THEN ({1 << 32}::UHUGEINT + (codes[n // 4 * 4 + {j + 1}] << {8 * j}) - {256 << (8 * j)}::UHUGEINT) & 4294967295::UHUGEINT ELSE codes[n // 4 * 4 + {j + 1}] << {8 * j} END ELSE 0::UHUGEINT END" for j in range(3)]
    tail_32 = f"xor(xor({tail[0]}, {tail[1]}), {tail[2]})"
    final_32 = _let("xor(w, n::UHUGEINT)", _times("xor(v, v >> 16)", bh.FINAL_32[0], 32))
    final_32 = _let(_let(final_32, _times("xor(v, v >> 13)", bh.FINAL_32[1], 32)), "xor(v, v >> 16)")
    d1, d2, (five_64, add_1, add_2) = bh.C1_64, bh.C2_64, bh.STEP_64
    one = f"((({_turned('xor(s[1], k[1])', 27)} + s[2]) * {five_64} + {add_1}::UHUGEINT) & {_MASK})"
    two = f"((({_turned('xor(s[2], k[2])', 31)} + {one}) * {five_64} + {add_2}::UHUGEINT) & {_MASK})"
    return f"""sized AS (SELECT *, len(codes) AS n FROM {source}),
    blocked AS (
      SELECT *,
        list_reduce(list_prepend(0::UHUGEINT, list_transform(range(n // 4), lambda i: {_scrambled(_number('4 * i', 4), c1, 15, c2, 32)})),
          lambda h, k: ({_turned('xor(h, k)', 13, 32)} * {five} + {add}::UHUGEINT) & 4294967295::UHUGEINT) AS a,
        list_reduce(list_prepend(0::UHUGEINT, list_transform(range(n // 8), lambda i: {_scrambled(_number('8 * i', 8), d1, 31, d2)})),
          lambda h, k: ({_turned('xor(h, k)', 27)} * {five_64} + {add_1}::UHUGEINT) & {_MASK}) AS b,
        list_reduce(list_prepend([0::UHUGEINT, 0::UHUGEINT], list_transform(range(n // 16), lambda i:
          [{_scrambled(_number('16 * i', 8), d1, 31, d2)}, {_scrambled(_number('16 * i + 8', 8), d2, 33, d1)}])),
          lambda s, k: [{one}, {two}]) AS c
      FROM sized),
    tailed AS (
      SELECT *, CASE WHEN n % 4 > 0 THEN xor(a, {_scrambled(tail_32, c1, 15, c2, 32)}) ELSE a END AS w,
        xor(CASE WHEN n % 8 > 0 THEN xor(b, {_scrambled(_left_over(8, 0, 7), d1, 31, d2)}) ELSE b END, n::UHUGEINT) AS x,
        xor(CASE WHEN n % 16 > 0 THEN xor(c[1], {_scrambled(_left_over(16, 0, 8), d1, 31, d2)}) ELSE c[1] END, n::UHUGEINT) AS y,
        xor(CASE WHEN n % 16 > 8 THEN xor(c[2], {_scrambled(_left_over(16, 8, 7), d2, 33, d1)}) ELSE c[2] END, n::UHUGEINT) AS z
      FROM blocked),
    added AS (SELECT *, (y + z) & {_MASK} AS y1, (y + z + z) & {_MASK} AS z1 FROM tailed),
    finished AS (SELECT *, {final_32} AS f32, {_mixed_64('x')} AS f64, {_mixed_64('y1')} AS y2, {_mixed_64('z1')} AS z2 FROM added),
    byte_hashes AS (
      SELECT *, {_signed('f32', 32)} AS h32, {_signed('f64', 64)} AS h64,
        {_let(f'(y2 + z2) & {_MASK}', _signed('v', 64))} AS h128_1, {_let(f'(y2 + z2 + z2) & {_MASK}', _signed('v', 64))} AS h128_2
      FROM finished)"""
