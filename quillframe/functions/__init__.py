from quillframe.functions.hashing import hash_below, hash_hex, hash_normal, hash_unit
from quillframe.functions.scalars import (
    confidence_bar,
    known,
    map_codes,
    percent,
    preview,
    round_to,
    signed_direction,
    softmax,
    softmax_argmax,
    zero_if_undefined,
)

__all__ = [
    "confidence_bar",
    "hash_below",
    "hash_hex",
    "hash_normal",
    "hash_unit",
    "known",
    "map_codes",
    "percent",
    "preview",
    "round_to",
    "signed_direction",
    "softmax",
    "softmax_argmax",
    "zero_if_undefined",
]
