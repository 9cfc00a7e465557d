"""Files as tables: stored documents, layout manifests, dictionaries, and what is fetched from elsewhere."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Versions known to be readable, size from which a file is large, dictionary categories and their folders in
# loading order.
VERSIONS = ("1.0", "1.1", "1.2", "1.3", "1.4", "1.5", "1.6", "1.7", "2.0")
LARGE = 50 * 1024 * 1024
CATEGORIES = {"organization": "organizations", "position": "positions", "rank": "ranks", "alias": "aliases", "historical": "historical", "typography": "typography", "layout": "layout_notes", "validation": "validation"}


def stored(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """One row for each file: file_name, path, content, content_hash, size, modified, version (`unknown` if the header has
    none) and warnings. The hash and header are computed where the bytes are. Files of no bytes are left out by the scan."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    head = F.regexp_extract(F.decode(F.substring("content", 1, 16), "ISO-8859-1"), r"^%PDF-(\d+\.\d+)", 1)
    version = F.when(head == "", "unknown").otherwise(head)
    warnings = F.array_sort(F.array_compact(F.array(F.when(F.col("length") > LARGE, "LARGE_FILE"), F.when(~version.isin(*VERSIONS), "UNSUPPORTED_VERSION"))))
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "content", F.sha2("content", 256).alias("content_hash"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), version.alias("version"), warnings.alias("warnings"))


_PAGE = "content_hash string, page_index int, text string, width double, height double, rotation int, image_count int, fonts array<string>, encrypted boolean, error string"


def _fonts(page) -> list[str]:
    """Names of the fonts that a page refers to, without the leading slash."""
    known = page.get("/Resources") or {}
    found = (known.get("/Font") or {}).values()
    bases = (f.get_object().get("/BaseFont") for f in found if hasattr(f, "get_object"))
    return sorted({str(base).lstrip("/") for base in bases if base is not None})


def pages(files: DataFrame) -> DataFrame:
    """content_hash, page_index, text, width, height, rotation, image_count, fonts, encrypted of each page of stored(), with an
    optional reader library. The text of a page that cannot be read is null; a file that cannot be read yields one row with
    null page_index and the error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import io

            from pypdf import PdfReader
        except ModuleNotFoundError:
            PdfReader = None
        for pdf in batches:
            rows = []
            for digest, content in zip(pdf["content_hash"], pdf["content"]):
                try:
                    if PdfReader is None:
                        raise RuntimeError("no reader library")
                    reader = PdfReader(io.BytesIO(content))
                    for i, page in enumerate(reader.pages):
                        try:
                            body, images = page.extract_text() or "", len(page.images)
                        except Exception:
                            body, images = None, None
                        rows.append((digest, i, body, float(page.mediabox.width), float(page.mediabox.height), int(page.get("/Rotate") or 0) % 360, images, _fonts(page), bool(reader.is_encrypted), None))
                except Exception as error:
                    rows.append((digest, None, None, None, None, None, None, None, None, str(error)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _PAGE.split(", ")]).astype({"page_index": "Int32", "rotation": "Int32", "image_count": "Int32"})

    return files.select("content_hash", "content").mapInPandas(read, _PAGE)


def _yaml(path: Path):
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """ordinal, layout_id, version, rules, checksum of `*/manifest.yaml` under root in the order of their paths. A manifest
    without rules, with repeated rule ids or with a weight that is not positive is an error."""
    rows = []
    for i, path in enumerate(sorted(Path(root).glob("*/manifest.yaml"))):
        m = _yaml(path)
        rules = [(str(r["rule_id"]), str(r["kind"]), str(r["value"]), float(r["weight"])) for r in m.get("rules") or []]
        if not rules or len({r[0] for r in rules}) < len(rules) or any(r[3] <= 0 for r in rules):
            raise ValueError(f"{path}: rules must be there, have ids of their own and positive weights")
        rows.append((i, str(m["era_id"]), int(m["version"]), rules, hashlib.sha256(path.read_bytes()).hexdigest()))
    return spark.createDataFrame(rows, "ordinal int, layout_id string, version int, rules array<struct<rule_id string, kind string, value string, weight double>>, checksum string")


def dictionary(spark: SparkSession, root: str) -> DataFrame:
    """The items of `<folder of a category>/**/*.yaml` under root, numbered from 1 in loading order. A missing folder holds
    none; a missing root, a file that is no mapping with a list of items, and an item without item_key, canonical_value or
    provenance_source are errors. Dictionaries are curated by hand and read by the driver."""
    if not Path(root).is_dir():
        raise FileNotFoundError(root)
    rows = []
    for category, folder in CATEGORIES.items():
        for path in sorted((Path(root) / folder).rglob("*.yaml")):
            whole = _yaml(path)
            items = whole.get("items", []) if isinstance(whole, dict) else None
            if not isinstance(items, list):
                raise ValueError(f"{path}: a mapping with a list of items is needed")
            for x in items:
                if not isinstance(x, dict) or (missing := {"item_key", "canonical_value", "provenance_source"} - set(x)):
                    raise ValueError(f"{path}: an item lacks {sorted(missing) if isinstance(x, dict) else 'everything'}")
                n, day = len(rows) + 1, [d if d is None or isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in (x.get("effective_from"), x.get("effective_to"))]
                rows.append((n, category, path.relative_to(root).as_posix(), str(x["item_key"]), str(x["canonical_value"]), *day, str(x["provenance_source"]), int(x.get("version", 1)), n))
    return spark.createDataFrame(rows, "id long, category string, source_file string, item_key string, canonical_value string, effective_from date, effective_to date, provenance_source string, version int, ordinal int")


def fetch(url: str, expected: tuple[int, ...] = (200,), types: tuple[str, ...] = (), timeout: float = 30) -> bytes:
    """The body of an HTTP or HTTPS address, if status and content type are as expected."""
    from urllib.request import urlopen

    if urlsplit(url).scheme not in ("http", "https"):
        raise ValueError(f"scheme of {url} is not allowed")
    with urlopen(url, timeout=timeout) as answer:
        kind = (answer.headers.get("Content-Type") or "").split(";")[0].strip().lower()
        if answer.status not in expected or types and kind not in {t.lower() for t in types}:
            raise ValueError(f"{url}: status {answer.status}, type {kind}")
        return answer.read()


def transfer(host: str, user: str, password: str, remote: str, local: str, timeout: float = 30) -> None:
    """Copy one remote file by FTP."""
    from ftplib import FTP

    with FTP(host, user, password, timeout=timeout) as ftp, open(local, "wb") as f:
        ftp.retrbinary(f"RETR {remote}", f.write)
