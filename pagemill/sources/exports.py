"""OCR export files: scan, hash, and the envelope around an engine's output.

A malformed file is data, not an error of the job: ``parse_exports`` gives every file either its
envelope or the code, check and message of what is wrong with it.
"""

from __future__ import annotations

import datetime
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pii import install_masking, mask_text
from ..functions.text import strip

# fixed values
TESSERACT, TEXTRACT, AZURE = "tesseract", "aws-textract", "azure-document-intelligence"
RECEIVE_CHECKS = ("file_json", "envelope_valid", "engine_supported")
COUNTRY_CHECK = "envelope_country_code_invalid"
DEFAULT_COUNTRY = "SG"
TESSERACT_COLUMNS = ("level", "text", "conf", "left", "top", "width", "height")
# fixed values: what is said of files that are not taken
MESSAGES = {
    "json": "file is not valid JSON: {}",
    "object": "export must be a JSON object",
    "missing": "envelope is missing {}",
    "part": "envelope is invalid: {} must be an object",
    "text": "envelope is invalid: {} must be a string",
    "engine": "envelope is invalid: ocr.engine must be a string and raw_output an object",
    "time": "envelope is invalid: ocr.processed_at is not a time",
    "country": "envelope source.country_code must be two letters (no country_code form field)",
    "country warning": "envelope source.country_code is not two letters; form field used",
    "unknown engine": "unknown ocr.engine {!r}; supported: {}",
    "tesseract keys": "tesseract raw_output is missing keys {}",
    "tesseract lists": "tesseract raw_output arrays must be lists",
    "tesseract lengths": "tesseract raw_output arrays differ in length",
    "textract blocks": "aws-textract raw_output.Blocks must be a list",
    "textract page": "aws-textract raw_output.Blocks has no PAGE block",
    "azure result": "azure raw_output.analyzeResult must be an object",
    "azure pages": "azure analyzeResult.pages must be a list",
    "azure content": "azure analyzeResult.content must be a string",
}
HTTP_STATUS = {"file_missing": 400, "unreadable_file": 422, "unsupported_ocr_format": 422, "unsupported_document_type": 422, "invalid_country_code": 422, "invalid_request": 422, "not_found": 404, "internal_server_error": 500}


def scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(path, filename, content) of the regular files of a folder, not of its subfolders.

    The reader lists no names that begin with a dot or an underscore.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), "content")


def upload(spark: SparkSession, content: bytes | None, filename: str | None) -> DataFrame:
    """One uploaded file as a table of files."""
    return spark.createDataFrame([(filename, filename, None if content is None else bytearray(content))], "path string, filename string, content binary")


def content_hash(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def normalise_country(code: Column) -> Column:
    """struct<code, invalid>: two ASCII letters in upper case; blank is null; anything else is invalid."""
    s = strip(code)
    good = s.rlike(r"\A[A-Za-z]{2}\z")
    return F.struct(F.when(good, F.upper(s)).alias("code"), (code.isNotNull() & (s != "") & ~good).alias("invalid"))


def resolve_country(form: Column, envelope: Column) -> Column:
    return F.coalesce(form, envelope, F.lit(DEFAULT_COUNTRY))


def safe_path(uri: Column, prefix: str = "file://data/") -> Column:
    """The path of a URI in the data zone, or null if it has another prefix or leads out of it."""
    rest = F.substring(uri, len(prefix) + 1, 1 << 30)
    return F.when(uri.startswith(prefix) & ~rest.startswith("/") & ~rest.rlike(r"(^|/)\.\.(/|$)"), rest)


def finite_number(v: Column) -> Column:
    """A JSON number of a variant as a double; null for anything else, texts and booleans too."""
    return F.when(F.substring(F.schema_of_variant(v), 1, 7).isin("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"), F.try_variant_get(v, "$", "double"))


def plain_text(v: Column) -> Column:
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


class _Rejected(Exception):
    def __init__(self, code: str, check: str, message: str):
        super().__init__(message)
        self.code, self.check, self.message = code, check, message


def _unsupported(message: str, check: str = "envelope_valid") -> _Rejected:
    return _Rejected("unsupported_ocr_format", check, message)


def _text_or_none(where: dict, key: str, name: str) -> str | None:
    if (value := where.get(key)) is not None and not isinstance(value, str):
        raise _unsupported(MESSAGES["text"].format(f"{name}.{key}"))
    return value


def _shape(engine: str, raw: dict) -> str | None:
    """What the declared engine's output lacks."""
    if engine == TESSERACT:
        if absent := [k for k in TESSERACT_COLUMNS if k not in raw]:
            return MESSAGES["tesseract keys"].format(absent)
        if not all(isinstance(raw[k], list) for k in TESSERACT_COLUMNS):
            return MESSAGES["tesseract lists"]
        return MESSAGES["tesseract lengths"] if len({len(raw[k]) for k in TESSERACT_COLUMNS}) > 1 else None
    if engine == TEXTRACT:
        if not isinstance(blocks := raw.get("Blocks"), list):
            return MESSAGES["textract blocks"]
        return None if any(isinstance(b, dict) and b.get("BlockType") == "PAGE" for b in blocks) else MESSAGES["textract page"]
    if engine == AZURE:
        if not isinstance(result := raw.get("analyzeResult"), dict):
            return MESSAGES["azure result"]
        if not isinstance(result.get("pages"), list):
            return MESSAGES["azure pages"]
        return None if isinstance(result.get("content"), str) else MESSAGES["azure content"]
    return MESSAGES["unknown engine"].format(engine, sorted((TESSERACT, TEXTRACT, AZURE)))


def _plain(value):
    """Numbers that JSON does not have become texts, which no number test takes."""
    if isinstance(value, float) and not math.isfinite(value):
        return str(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def _country(value) -> tuple[str | None, bool]:
    if value is None or (isinstance(value, str) and not value.strip()):
        return None, False
    good = isinstance(value, str) and re.fullmatch("[A-Za-z]{2}", value.strip())
    return (value.strip().upper(), False) if good else (None, True)


def read_envelope(content: bytes, form_country: str | None) -> dict:
    """The columns of ENVELOPE for one file."""
    out: dict = dict.fromkeys(ENVELOPE)
    try:
        try:
            data = json.loads(content)
        except (UnicodeDecodeError, json.JSONDecodeError, RecursionError) as e:
            raise _Rejected("unreadable_file", "file_json", MESSAGES["json"].format(type(e).__name__)) from None
        top = data if isinstance(data, dict) else {}
        source, ocr = (top.get(k) if isinstance(top.get(k), dict) else {} for k in ("source", "ocr"))
        # what can be told of a file that is rejected below
        names = {"source_sha256": (source, "source_sha256"), "source_filename": (source, "original_filename"), "source_mime_type": (source, "mime_type"), "ocr_engine": (ocr, "engine"), "ocr_engine_version": (ocr, "engine_version")}
        out |= {k: w.get(j) if isinstance(w.get(j), str) else None for k, (w, j) in names.items()}
        out["envelope_country"], invalid = _country(source.get("country_code"))
        if not isinstance(data, dict):
            raise _unsupported(MESSAGES["object"])
        absent = [k for k in ("source", "ocr", "raw_output") if k not in data] or [k for k in ("ocr.engine",) if "engine" not in ocr]
        if absent:
            raise _unsupported(MESSAGES["missing"].format(absent))
        for name, where, keys in (("source", source, ("original_filename", "mime_type", "source_sha256")), ("ocr", ocr, ("engine", "engine_version", "processed_at"))):
            if not isinstance(data[name], dict):
                raise _unsupported(MESSAGES["part"].format(name))
            for key in keys:
                _text_or_none(where, key, name)
        if ocr["engine"] is None or not isinstance(data["raw_output"], dict):
            raise _unsupported(MESSAGES["engine"])
        if at := ocr.get("processed_at"):
            try:
                out["ocr_processed_at"] = datetime.datetime.fromisoformat(at).isoformat()
            except ValueError:
                raise _unsupported(MESSAGES["time"]) from None
        if wrong := _shape(ocr["engine"], data["raw_output"]):
            raise _unsupported(wrong, "engine_supported")
        if invalid and not form_country:
            raise _Rejected("invalid_country_code", "envelope_valid", MESSAGES["country"])
        out |= {"country_warning": invalid, "raw_output": json.dumps(_plain(data["raw_output"]), ensure_ascii=False)}
    except _Rejected as e:
        out |= {"error_code": e.code, "failed_check": e.check, "error_message": e.message[:2000]}
    return out


ENVELOPE = ("source_sha256", "source_filename", "source_mime_type", "envelope_country", "ocr_engine", "ocr_engine_version", "ocr_processed_at", "raw_output", "error_code", "failed_check", "error_message", "country_warning")


def _read(content: bytes | None, form_country: str | None) -> dict:
    """``read_envelope``; whatever else goes wrong with a file is an error of that file alone."""
    if not content:
        return dict.fromkeys(ENVELOPE) | {"error_code": "file_missing"}
    try:
        return read_envelope(content, form_country)
    except Exception as e:  # noqa: BLE001
        return dict.fromkeys(ENVELOPE) | {"error_code": "internal_server_error", "failed_check": "file_json", "error_message": mask_text(f"{type(e).__name__}: {e}")[:2000]}


#: So many bytes of files are read at a time, or one file.
PART_BYTES = 1 << 20


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most PART_BYTES of content, or one row."""
    start, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(batch.column("content")), 0).to_pylist()):
        if i > start and held + size > PART_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def parse_exports(files: DataFrame, form_country: str | None = None) -> DataFrame:
    """Files (filename, content, and columns to keep) with the ENVELOPE columns instead of content.

    JSON is read by Python, for its encodings and its rule for repeated keys; the rest of the
    engine works on the columns.  Null or empty content is ``file_missing``.
    """
    keep = [c for c in files.columns if c != "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        install_masking()
        types = [pa.bool_() if c == "country_warning" else pa.string() for c in ENVELOPE]
        for some in (part for batch in batches for part in _parts(batch)):
            rows = [_read(x.as_py(), form_country) for x in some.column("content")]
            yield pa.RecordBatch.from_arrays([*(some.column(c) for c in keep), *(pa.array([r[c] for r in rows], t) for c, t in zip(ENVELOPE, types, strict=True))], [*keep, *ENVELOPE])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema if f.name != "content")
    return files.select(*keep, "content").mapInArrow(run, f"{kept}, " + ", ".join(f"{c} {'boolean' if c == 'country_warning' else 'string'}" for c in ENVELOPE))


def receive_checks(parsed: DataFrame) -> DataFrame:
    """Check rows of the receive stage: those before the failing one passed, those after did not run."""
    at = F.coalesce(F.array_position(F.array(*map(F.lit, RECEIVE_CHECKS)), F.col("failed_check")).cast("int"), F.lit(0))
    ran = F.slice(F.array(*map(F.lit, RECEIVE_CHECKS)), 1, F.when(at == 0, len(RECEIVE_CHECKS)).otherwise(at))
    details = F.when(F.col("name") == F.col("failed_check"), F.to_json(F.struct("error_code", F.substring("error_message", 1, 500).alias("message")))).otherwise("{}")
    none = F.lit(None).cast("int").alias("page_number")
    rows = parsed.withColumn("name", F.explode(ran)).select("document_id", none, F.col("name").alias("check_name"), (~F.col("name").eqNullSafe(F.col("failed_check"))).alias("passed"), F.lit("error").alias("severity"), details.alias("details"))
    warning = parsed.where("country_warning").select("document_id", none, F.lit(COUNTRY_CHECK).alias("check_name"), F.lit(False).alias("passed"), F.lit("warning").alias("severity"), F.to_json(F.struct(F.lit(MESSAGES["country warning"]).alias("message"), F.col("country_code").alias("used_country_code"))).alias("details"))
    return rows.unionByName(warning)
