"""What the outside services are asked for: datasets by resolution, query parameters, addresses. Nothing here opens a connection."""

from __future__ import annotations

# The names under which an outside inventory lists its elevation datasets, in order of preference.
NINTH = "National Elevation Dataset (NED) 1/9 arc-second"
THIRD = "National Elevation Dataset (NED) 1/3 arc-second"
WHOLE = "National Elevation Dataset (NED) 1 arc-second"
DEFAULT_DATASETS = [
    "Digital Elevation Model (DEM) 1 meter",
    "1-meter DEM",
    "3DEP Elevation: DEM (1 meter)",
    "Seamless 1-meter DEM (Limited Availability)",
    "DEM Source (OPR)",
    NINTH,
    THIRD,
    WHOLE,
]
RESOLUTIONS = {"1m": DEFAULT_DATASETS, "10m": [THIRD, NINTH, WHOLE], "30m": [WHOLE, THIRD, NINTH]}
FORMATS = "GeoTIFF,IMG,TIF"


def datasets_for(resolution: str | None = None, datasets: list[str] | None = None) -> list[str]:
    """The datasets to ask for: a resolution's, else those given, else the usual ones. An unknown resolution is an error."""
    if resolution:
        if resolution not in RESOLUTIONS:
            raise ValueError(f"Unknown resolution {resolution}; expected one of {', '.join(RESOLUTIONS)}")
        return RESOLUTIONS[resolution]
    return datasets or DEFAULT_DATASETS


def query_params(box: tuple[float, float, float, float], dataset: str, most: int) -> dict:
    """Parameters of one inventory query."""
    return {"bbox": ",".join(map(str, box)), "datasets": dataset, "prodFormats": FORMATS, "outputFormat": "JSON", "max": most}


def primary_url(urls) -> str | None:
    """The first usable address of a list or a mapping of addresses, or of records with one."""
    entries = urls if isinstance(urls, list) else list(urls.values()) if isinstance(urls, dict) else []
    for entry in entries:
        if isinstance(entry, dict):
            if found := entry.get("url") or entry.get("URL"):
                return str(found)
        elif isinstance(entry, str) and entry.startswith("http"):
            return entry
    return None
