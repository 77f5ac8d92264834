"""Points in areas against tests of all pairs."""

import random

import pytest

from geoweave.operators import matching, spatial

AREA = "polygon_id string, geometry array<array<array<struct<lon:double,lat:double>>>>"


def ring(*points):
    return [{"lon": float(x), "lat": float(y)} for x, y in [*points, points[0]]]


def star(rng, x, y, size, n):
    import math

    return ring(*((x + size * r * math.cos(2 * math.pi * i / n), y + size * r * math.sin(2 * math.pi * i / n)) for i, r in enumerate(rng.uniform(0.3, 1) for _ in range(n))))


def holds(geometry, x, y):
    def odd(points):
        edges = zip(points, points[1:] + points[:1])
        return sum((a["lat"] > y) != (b["lat"] > y) and x < (b["lon"] - a["lon"]) * (y - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"] for a, b in edges) % 2 == 1

    return any(odd(p[0]) and not any(map(odd, p[1:])) for p in geometry)


def world(seed=1):
    rng = random.Random(seed)
    areas = [(f"s{n}", [[star(rng, rng.uniform(-150, 150), rng.uniform(-60, 60), 10 ** rng.uniform(-3, 1.6), rng.randint(3, 40))]]) for n in range(60)]
    areas.append(("hole", [[ring((0, 0), (40, 0), (40, 40), (0, 40)), ring((10, 10), (20, 10), (20, 20), (10, 20))], [ring((12, 12), (14, 12), (14, 14), (12, 14))]]))
    areas.append(("wide", [[ring((-179, -89), (179, -89), (179, 89), (-179, 89))]]))
    areas += [("none", None), ("empty", []), ("far", [[ring((1e6, 1e6), (2e6, 1e6), (1e6, 2e6))]])]
    points = [(n, rng.uniform(-180, 180), rng.uniform(-90, 90)) for n in range(400)]
    for name, g in areas[:61]:
        p = rng.choice(g[0][0])
        points += [(len(points) + i, p["lon"] + rng.gauss(0, 0.01), p["lat"] + rng.gauss(0, 0.01)) for i in range(4)]
    points += [(9001, 15.0, 15.0), (9002, 13.0, 13.0), (9003, None, 1.0), (9004, float("nan"), 1.0), (9005, float("inf"), 0.0), (9006, 1.2e6, 1.2e6), (9007, 5.0, 5.0), (9007, 5.0, 5.0)]
    return areas, points


def brute(areas, points):
    fine = lambda x: x is not None and abs(x) < float("inf")
    return sorted((n, name) for n, x, y in points if fine(x) and fine(y) for name, g in areas if g and holds(g, x, y))


def got(spark, areas, points, **options):
    found = spatial.points_in_areas(spark.createDataFrame(points, "k long, lon double, lat double"), spark.createDataFrame(areas, AREA), key=["k"], **options)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("max_cells", [4, 64, 400])
def test_all_points_and_areas_equal_all_pairs(spark, max_cells):
    areas, points = world()
    assert got(spark, areas, points, max_cells=max_cells) == brute(areas, points)


def test_shuffled_and_salted_cells(spark, monkeypatch):
    monkeypatch.setattr(spatial, "MAX_BROADCAST_CELLS", 0)
    monkeypatch.setattr(matching, "HOT_ROWS", 5)
    areas, points = world(2)
    assert got(spark, areas, points) == brute(areas, points)


def test_corners_and_borders_follow_the_exact_test(spark):
    areas = [("a", [[ring((0, 0), (1, 0), (1, 1), (0, 1))]]), ("b", [[ring((1, 0), (2, 0), (2, 1), (1, 1))]])]
    points = [(n, x / 4, y / 4) for n, (x, y) in enumerate((x, y) for x in range(-1, 10) for y in range(-1, 6))]
    found = got(spark, areas, points)
    assert found == brute(areas, points) and len({k for k, _ in found}) == len(found)


def test_cells_are_disjoint_and_few(spark):
    areas, _ = world(3)
    for _, g in areas:
        cells = spatial.cover(g)
        assert len(cells) <= spatial.MAX_CELLS + 4
        finest = max((c[0] for c in cells), default=0)
        seen = set()
        for level, column, row, _ in cells:
            for other, c, r, _ in cells:
                if other > level:
                    assert (c >> (other - level), r >> (other - level)) != (column, row)
            assert (level, column, row) not in seen and finest <= spatial.MAX_LEVEL
            seen.add((level, column, row))
    assert any(whole for *_, whole in spatial.cover(areas[61][1]))


def test_nothing(spark):
    areas, points = world()
    assert got(spark, [("none", None)], points) == [] and got(spark, areas, points[:0]) == []
