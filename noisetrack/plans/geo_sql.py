"""Geometry as SQL text, for the oracle queries."""


def haversine_km(a: str, b: str, c: str, d: str) -> str:
    return f"(2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))))"


def bearing(a: str, b: str, c: str, d: str) -> str:
    y = f"sin(radians({d} - {b})) * cos(radians({c}))"
    x = f"cos(radians({a})) * sin(radians({c})) - sin(radians({a})) * cos(radians({c})) * cos(radians({d} - {b}))"
    return f"((degrees(atan2({y}, {x})) + 360) % 360)"


def ang_diff(a: str, b: str) -> str:
    return f"least(abs({a} - {b}) % 360, 360 - abs({a} - {b}) % 360)"


def advance(lat: str, lon: str, heading: str, dist: str) -> tuple[str, str]:
    ang = f"(({dist}) / 6371000.0)"
    phi2 = f"asin(sin(radians({lat})) * cos({ang}) + cos(radians({lat})) * sin({ang}) * cos(radians({heading})))"
    lon2 = f"degrees(radians({lon}) + atan2(sin(radians({heading})) * sin({ang}) * cos(radians({lat})), cos({ang}) - sin(radians({lat})) * sin({phi2})))"
    return f"degrees({phi2})", lon2


def move(lat: str, lon: str, heading: str, dist: str) -> tuple[str, str]:
    return f"({lat} + degrees(({dist}) * cos(radians({heading})) / 6371000.0))", f"({lon} + degrees(({dist}) * sin(radians({heading})) / (6371000.0 * cos(radians({lat})))))"


def slant_km(horizontal: str, altitude: str) -> str:
    return f"sqrt(({horizontal}) * ({horizontal}) + greatest({altitude}, 0.0) / 1000 * (greatest({altitude}, 0.0) / 1000))"
