"""Metadata expressions: hosts, regions, dates and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import col

# The host categories' words, in the order in which they are tried.
OTHER_EXACT = (
    "host", "mammals", "other mammals", "feces", "environment", "water sample", "other environment",
    "animal", "surface swab", "air sample", "unknown", "insect",
)
SWINE_EXACT = ("swine", "pig")
SWINE_PARTS = ("sus scrofa", "sus ")
EQUINE = ("equine", "equus caballus", "horse", "donkey")
BOVINE = ("dairy cow", "bovine", "cow", "cattle")
CANINE = ("canine", "dog")
FELINE = ("feline", "cat")
MARINE = ("seal", "dolphin", "whale", "sea lion", "walrus")
MAMMALS = ("ferret", "mink", "mouse", "mus musculus", "rodent", "bat", "meerkat", "panda", "camel", "primate")
# Words anywhere in a host name that make it a bird.
BIRD_WORDS = (
    "avian", "bird", "fowl", "poultry", "waterfowl", "duck", "goose", "swan", "teal", "mallard", "pintail", "wigeon", "shoveler",
    "chicken", "turkey", "quail", "pheasant", "partridge", "grouse", "peafowl", "peacock", "gull", "tern", "eagle", "hawk", "falcon",
    "kestrel", "harrier", "buzzard", "crow", "raven", "magpie", "pigeon", "dove", "sparrow", "finch", "swallow", "penguin", "cormorant",
    "pelican", "heron", "ibis", "stork", "crane", "bustard", "sandpiper", "turnstone", "knot", "dunlin", "sanderling", "curlew", "plover",
    "shearwater", "albatross", "petrel", "grebe", "coot", "rail", "ostrich", "great tit", "passerine",
)
# Bird genera, compared with the first word of a host name.
BIRD_GENERA = (
    "gallus", "meleagris", "coturnix", "coturnic", "numida", "phasianus", "phasanius", "alectoris", "pavo", "perdix", "cyrtonyx", "oreortyx",
    "francolinus", "polyplectron", "lophura", "anas", "anser", "cygnus", "branta", "chen", "cairina", "aythya", "bucephala", "tadorna", "aix",
    "mareca", "melanitta", "somateria", "clangula", "oxyura", "mergus", "lophodytes", "dendrocygna", "netta", "larus", "sterna",
    "chroicocephalus", "leucophaeus", "gelochelidon", "chlidonias", "hydroprogne", "rissa", "xema", "larosterna", "rynchops", "calidris",
    "arenaria", "numenius", "tringa", "scolopax", "catoptrophorus", "himantopus", "gallinago", "falco", "buteo", "accipiter", "haliaeetus",
    "halietus", "circus", "parabuteo", "nisaetus", "morphnus", "necrosyrtes", "gyps", "corvus", "pica", "columba", "streptopelia",
    "pygoscelis", "spheniscus", "podiceps", "tachybaptus", "gallinula", "anthropoides", "passer", "hirundo", "zosterops", "copsychus",
    "garrulax", "gracula", "stercorarius", "falsco", "anseriformes",
)

HOST_GROUPS = ("human", "avian", "swine", "bovine", "other")
# Continents with a group of their own.
CONTINENTS = {"North America": "north_america", "Europe": "europe", "Asia": "asia"}
GEO_GROUPS = ("north_america", "europe", "asia", "other")
TEMPORAL_GROUPS = ("early", "late", "unknown")
UNRECOGNIZED = "__unrecognized__"

#: White space of any kind at either end.
_ENDS = r"^\s+|\s+$"


def host_group(host: Column | str, strict: bool = True) -> Column:
    """Host category; the first rule that fits decides, null is `other`.

    An unknown host is an error when strict, else a mark of its own.
    """
    h = F.lower(col(host))
    unknown = F.raise_error(F.concat(F.lit("unrecognized host: "), h)).cast("string") if strict else F.lit(UNRECOGNIZED)
    return (
        F.when(h.isNull(), "other").when(h.isin(*OTHER_EXACT), "other").when(h.contains("laboratory"), "other").when(h == "human", "human")
        .when(h.isin(*SWINE_EXACT), "swine").when(h.contains(SWINE_PARTS[0]) | h.contains(SWINE_PARTS[1]), "swine").when(h.isin(*EQUINE), "other")
        .when(h.isin(*BOVINE), "bovine").when(h.isin(*CANINE) | h.contains("canis"), "other").when(h.isin(*FELINE) | h.contains("felis"), "other")
        .when(h.isin(*MARINE) | h.isin(*MAMMALS), "other").when(h.rlike("|".join(BIRD_WORDS)), "avian")
        .when(F.regexp_extract(h, r"^\s*(\S+)", 1).isin(*BIRD_GENERA), "avian").otherwise(unknown)
    )


def geographic_group(location: Column | str) -> Column:
    """Group of the continent before the first `/`; case counts, null and blank are `other`."""
    continent = F.regexp_replace(F.substring_index(col(location), "/", 1), _ENDS, "")
    out = F.lit(None).cast("string")
    for name, group in CONTINENTS.items():
        out = F.when(continent == name, group).otherwise(out)
    return F.coalesce(out, F.lit("other"))


def parse_date(text: Column | str) -> Column:
    """Year, month and day; anything else, partial dates too, is null."""
    t = F.regexp_replace(col(text), _ENDS, "")
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d"))


def temporal_group(date: Column | str, median: Column) -> Column:
    """`early` up to the median itself, `late` after it, `unknown` without a date."""
    d = col(date)
    return F.when(d.isNull(), "unknown").when(d <= median, "early").otherwise("late")


def iso_or_na(date: Column | str) -> Column:
    return F.coalesce(F.date_format(col(date), "yyyy-MM-dd"), F.lit("N/A"))


def strip_type_prefix(subtype: Column | str) -> Column:
    """Without a leading `A / `."""
    s = col(subtype)
    return F.when(s.startswith("A / "), F.substr(s, F.lit(5))).otherwise(s)


def group_label(segment: Column | str, grp: Column | str) -> Column:
    return F.format_string("%s (%s)", col(segment), col(grp))


def label_order(label: Column | str) -> list[Column]:
    """HA groups first, then NA, then the rest, each by name."""
    c = col(label)
    return [F.when(c.startswith("HA"), 0).when(c.startswith("NA"), 1).otherwise(2), c]


def magnitude(number_text: Column | str) -> Column:
    """Decimal magnitude of a number kept as text."""
    return F.length(col(number_text)) - 1
