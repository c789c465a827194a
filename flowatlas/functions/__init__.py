from flowatlas.functions.expressions import (
    differs,
    json_path,
    last_path_part,
    let,
    parse_json,
    pretty_json,
    random_id,
    surrogate_key,
)
from flowatlas.functions.globs import ensure_json_suffix, glob_to_regex, matches_glob
from flowatlas.functions.packing import pack_columns, packed, text_columns, unpack_columns, unpacked

__all__ = [
    "differs",
    "ensure_json_suffix",
    "glob_to_regex",
    "json_path",
    "last_path_part",
    "let",
    "matches_glob",
    "pack_columns",
    "packed",
    "parse_json",
    "pretty_json",
    "random_id",
    "surrogate_key",
    "text_columns",
    "unpack_columns",
    "unpacked",
]
