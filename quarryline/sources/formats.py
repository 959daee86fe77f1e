"""What a file specification may say, and the defaults for what it leaves out."""

from __future__ import annotations

from collections.abc import Mapping

# File formats that can be named in a specification.
FORMATS = ("csv", "excel", "json", "parquet", "pickle")

# Codecs by format; the key is what a specification says, the value what Spark calls it.
CODECS = {
    "csv": {"none": "none", "gzip": "gzip", "bz2": "bzip2", "bzip2": "bzip2", "zstd": "zstd"},
    "json": {"none": "none", "gzip": "gzip", "bz2": "bzip2", "bzip2": "bzip2", "deflate": "deflate"},
    "parquet": {"none": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "lz4": "lz4", "brotli": "brotli"},
    "pickle": {"none": "none", "gzip": "gzip", "bz2": "bz2", "xz": "xz", "zip": "zip"},
    "excel": {"none": "none"},
}

# Codec meant by ``infer``, from the ending of the name; parquet has its own default.
ENDINGS = {".gz": "gzip", ".bz2": "bz2", ".xz": "xz", ".zip": "zip"}

SOURCE_FILE_COLUMN = "Source Data File Name"


def file_format(spec: Mapping) -> str:
    """The checked, lower-case format of a specification."""
    if "format" not in spec:
        raise ValueError('a file specification needs a "format"')
    chosen = str(spec["format"]).lower()
    if chosen not in FORMATS:
        raise ValueError(f'file format {chosen!r} is not one of {", ".join(FORMATS)}')
    return chosen


def field_delimiter(spec: Mapping) -> str:
    return spec.get("field delimiter", spec.get("field-delimiter", ","))


def codec(spec: Mapping) -> str:
    """The Spark codec to write with; codecs Spark cannot write are refused by name."""
    chosen = file_format(spec)
    wanted = str(spec.get("compression", "infer") or "none").lower()
    if wanted == "infer":
        name = str(spec.get("name", "")).lower()
        wanted = next((c for ending, c in ENDINGS.items() if name.endswith(ending)), "none")
        if chosen == "parquet":
            wanted = "snappy"
        elif chosen == "excel":
            wanted = "none"
    known = CODECS[chosen]
    if wanted not in known:
        raise ValueError(
            f"{chosen} files cannot be written with {wanted!r} compression here; "
            f"choose one of {', '.join(sorted(known))}"
        )
    return known[wanted]


def with_defaults(spec: Mapping) -> dict:
    """The specification with every default spelled out."""
    return {
        **spec,
        "format": file_format(spec),
        "field delimiter": field_delimiter(spec),
        "compression": codec(spec),
        "worksheet": worksheet(spec),
    }


def worksheet(spec: Mapping) -> str | int:
    """Sheet name or zero-based number; the first sheet unless a list says otherwise."""
    listed = spec.get("worksheet list", 0)
    if isinstance(listed, (list, tuple)):
        return listed[0] if listed else 0
    return listed
