"""Scene identifiers, names and paths."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

SCENE = r"^CBERS4A_WPM(\d{3})(\d{3})(\d{8})(?:ETC2)?$"

#: The federative units of Brazil, with the codes of its statistics office.
STATES = {
    "AC": (12, "Acre"), "AL": (27, "Alagoas"), "AP": (16, "Amapá"), "AM": (13, "Amazonas"), "BA": (29, "Bahia"),
    "CE": (23, "Ceará"), "DF": (53, "Distrito Federal"), "ES": (32, "Espírito Santo"), "GO": (52, "Goiás"),
    "MA": (21, "Maranhão"), "MT": (51, "Mato Grosso"), "MS": (50, "Mato Grosso do Sul"), "MG": (31, "Minas Gerais"),
    "PA": (15, "Pará"), "PB": (25, "Paraíba"), "PR": (41, "Paraná"), "PE": (26, "Pernambuco"), "PI": (22, "Piauí"),
    "RJ": (33, "Rio de Janeiro"), "RN": (24, "Rio Grande do Norte"), "RS": (43, "Rio Grande do Sul"),
    "RO": (11, "Rondônia"), "RR": (14, "Roraima"), "SC": (42, "Santa Catarina"), "SP": (35, "São Paulo"),
    "SE": (28, "Sergipe"), "TO": (17, "Tocantins"),
}


def _decomposed() -> tuple[str, str]:
    """Lower-case Latin letters with marks that decompose to one plain letter (NFKD), and these letters."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        rest = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if chr(code).islower() and len(rest) == 1 and rest != chr(code):
            pairs.append((chr(code), rest))
    return tuple(map("".join, zip(*pairs, strict=True)))


ACCENTED, PLAIN = _decomposed()


def scene_part(scene_id: Column, k: int) -> Column:
    """Path, row or date (1, 2, 3) of a scene's id; null if the whole id does not fit."""
    return F.when(F.regexp_like(scene_id, F.lit(SCENE)), F.regexp_extract(scene_id, SCENE, k))


def strict_scene_part(scene_id: Column, k: int) -> Column:
    return F.coalesce(scene_part(scene_id, k), F.raise_error(F.concat(F.lit("not a scene id: "), scene_id)).cast("string"))


def band_prefix(scene_id: Column) -> Column:
    part = lambda k: scene_part(scene_id, k)
    return F.concat_ws("_", F.lit("CBERS_4A_WPM"), part(3), part(1).cast("int").cast("string"), part(2).cast("int").cast("string"))


def plain(text: Column) -> Column:
    """Trimmed, lower case, without accents, whether letters come composed or with marks of their own."""
    return F.regexp_replace(F.translate(F.lower(F.trim(text)), ACCENTED, PLAIN), r"\p{M}", "")


def basename(url: Column) -> Column:
    return F.substring_index(F.substring_index(url, "?", 1), "/", -1)


def band_base(name: Column) -> Column:
    """A band file's name up to its band."""
    return F.substring_index(name, "_BAND", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.regexp_extract(name, r"(\.[^.]*)$", 1)
