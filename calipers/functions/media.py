"""Names and paths of images and outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guid_of_url(url: Column, part: int = 5) -> Column:
    """The `part`-th piece of the url between slashes; null when there are fewer."""
    return F.nullif(F.split_part(url, F.lit("/"), F.lit(part)), F.lit(""))


def _extension(name: Column) -> Column:
    # the last dot starts the extension if something other than dots precedes it
    return F.regexp_extract(name, r"^.*[^.].*?(\.[^.]*)$", 1)


def image_parts(image: Column, url_base: str) -> Column:
    """struct(guid, ext, filename, url) of an image reference; the extension defaults to .jpg."""
    name = F.substring_index(image, "/", -1)
    found = _extension(name)
    guid = F.substr(name, F.lit(1), F.length(name) - F.length(found))
    ext = F.when(found == "", F.lit(".jpg")).otherwise(found)
    filename = F.concat(guid, ext)
    url = F.concat_ws("/", F.lit(url_base.rstrip("/")), F.substring(filename, 1, 2), filename)
    return F.struct(guid.alias("guid"), ext.alias("ext"), filename.alias("filename"), url.alias("url"))


def rendition_name(filename: Column, size: Column) -> Column:
    """`lamp.jpg`, 400 -> `lamp_400.jpg`."""
    ext = _extension(filename)
    stem = F.substr(filename, F.lit(1), F.length(filename) - F.length(ext))
    return F.concat(stem, F.lit("_"), size.cast("string"), ext)


def bucket_and_blob(path: Column, scheme: str = "gs") -> Column:
    """struct(bucket, blob) of a storage path, null fields when the path has another form."""
    def pick(group: int) -> Column:
        pattern = rf"^{scheme}://([^/]+)/(.*)$"
        return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, group))

    return F.struct(pick(1).alias("bucket"), pick(2).alias("blob"))


def join_path(*pieces: Column) -> Column:
    return F.concat_ws("/", *pieces)


def output_title(item: Column, style: Column) -> Column:
    """Base name of an annotated picture: item and style with a comma between."""
    return F.concat_ws(",", item, style)
