"""Patrol routes over hotspot stops.

Stops per (area, shift) are hotspots - their count is bounded by the number
of hotspots chosen per area (k), never by incident rows.  The shortest open
path is found exactly by dynamic programming as DataFrame steps: a state is
(group, set of visited stops, last stop) with its shortest length and route;
one step joins the legs to unvisited stops and keeps the best of each state.
All groups advance together, and states spread over all tasks.  Beyond
``MAX_STOPS`` stops the states double with every stop; larger groups are
searched by evolution (``genetic_routes``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.functions.geo import geo_km
from hotbeat.session import cut_lineage, spread_groups

#: Stops of a group that are searched exactly (2^n states a last stop); larger groups by evolution.
MAX_STOPS = 16
#: Evolution: islands of a group, routes of an island, generations between two exchanges, and exchanges.
ISLANDS, POPULATION, GENERATIONS, EPOCHS = 4, 32, 80, 4
#: Share of children that are mutated.
MUTATION = 0.3
#: Lengths are whole millionths of a km while routes are compared: sums are exact.
UNITS_PER_KM = 1_000_000


def _as_list(by) -> list[str]:
    if not by:
        return []
    return [by] if isinstance(by, str) else list(by)


def distance_matrix(stops: DataFrame, by, id_col: str = "hotspot_id", lat: str = "lat", lon: str = "lon",
                    method: str = "sphere") -> DataFrame:
    """(by, a, b, km) for a < b inside each group of stops (k stops -> k(k-1)/2 rows)."""
    by = _as_list(by)
    a = stops.select(*by, F.col(id_col).alias("a"), F.col(lat).alias("a_lat"), F.col(lon).alias("a_lon"))
    b = stops.select(*by, F.col(id_col).alias("b"), F.col(lat).alias("b_lat"), F.col(lon).alias("b_lon"))
    j = a.join(b, by).filter(F.col("a") < F.col("b"))
    return j.select(*by, "a", "b", geo_km("a_lat", "a_lon", "b_lat", "b_lon", method).alias("km"))


def route_length(stops: DataFrame, route_key, seq: str = "seq", lat: str = "lat", lon: str = "lon",
                 method: str = "sphere") -> DataFrame:
    """Open-path length = sum of distances to the previous stop."""
    key = _as_list(route_key)
    w = Window.partitionBy(*key).orderBy(seq)
    legs = stops.select(*key, seq, lat, lon, F.lag(lat).over(w).alias("__plat"), F.lag(lon).over(w).alias("__plon"))
    legs = legs.withColumn("__km", F.when(F.col("__plat").isNotNull(),
                                          geo_km("__plat", "__plon", lat, lon, method)))
    return legs.groupBy(*key).agg(F.coalesce(F.sum("__km"), F.lit(0.0)).alias("km"),
                                  F.count(F.lit(1)).alias("stops"))


def _numbered(stops: DataFrame, by: list[str], id_col: str, lat: str, lon: str, start_col: str | None) -> DataFrame:
    """(g, id, la, lo, first, i): stops of a group numbered from 0, the start first."""
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    first = F.col(start_col).cast("int") if start_col else F.lit(0)
    order = Window.partitionBy("g").orderBy(F.desc("first"), "id")
    return (stops.select(group.alias("g"), F.col(id_col).cast("long").alias("id"), F.col(lat).alias("la"), F.col(lon).alias("lo"), first.alias("first"))
            .withColumn("i", F.row_number().over(order) - 1))


def plan_routes(stops: DataFrame, by, id_col: str = "hotspot_id", lat: str = "lat", lon: str = "lon",
                fixed_start: bool = False, start_col: str | None = None) -> DataFrame:
    """Best visiting order per group -> (by, route array<bigint>, km).

    ``fixed_start``: the stop flagged by ``start_col`` (else the smallest id)
    is always first.  Groups of at most ``MAX_STOPS`` stops get a shortest route, of
    equally long ones that with the smaller ids in front; larger groups the best of
    ``genetic_routes``.  Groups may have null keys.
    """
    by = _as_list(by)
    s = cut_lineage(_numbered(stops, by, id_col, lat, lon, start_col))
    sizes = s.groupBy("g").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > MAX_STOPS).select(F.col("g").alias("g2"))  # groups
    small = s.join(large, F.col("g") == F.col("g2"), "left_anti")
    out = _shortest(small, fixed_start)
    if not large.isEmpty():
        out = out.unionByName(_evolved(s.join(large, F.col("g") == F.col("g2"), "left_semi"), fixed_start))
    return out.select(*[F.col("g")[c].alias(c) for c in by], "route", "km")


def _shortest(s: DataFrame, fixed_start: bool) -> DataFrame:
    """(g, route, km) by dynamic programming over (visited set, last stop)."""
    most = s.agg(F.max("i")).first()[0]
    a = s.select("g", F.col("i").alias("from"), F.col("la").alias("la1"), F.col("lo").alias("lo1"))
    b = s.select(F.col("g").alias("g2"), F.col("i").alias("to"), F.col("id").alias("to_id"), "la", "lo")
    leg = F.round(geo_km("la1", "lo1", "la", "lo") * UNITS_PER_KM).cast("long")
    legs = cut_lineage(a.join(b, (F.col("g") == F.col("g2")) & (F.col("from") != F.col("to")))
                       .select("g2", "from", "to", "to_id", leg.alias("leg")))
    state = (s.filter(F.col("i") == 0) if fixed_start else s).select(
        "g", F.expr("shiftleft(1L, i)").alias("visited"), F.col("i").alias("last"),
        F.struct(F.lit(0).cast("long").alias("length"), F.array("id").alias("route")).alias("best"))
    for _ in range(most or 0):
        step = state.join(legs, (F.col("g") == F.col("g2")) & (F.col("last") == F.col("from"))
                          & F.expr("(visited & shiftleft(1L, to)) = 0"), "left")  # a finished group stays as it is
        state = (step.select("g", F.expr("CASE WHEN to IS NULL THEN visited ELSE visited | shiftleft(1L, to) END").alias("visited"),
                             F.coalesce("to", "last").alias("last"),
                             F.struct((F.col("best.length") + F.coalesce("leg", F.lit(0))).alias("length"),
                                      F.when(F.col("to").isNull(), F.col("best.route")).otherwise(F.concat("best.route", F.array("to_id"))).alias("route")).alias("best"))
                 .groupBy("g", "visited", "last").agg(F.min("best").alias("best")))
    out = state.groupBy("g").agg(F.min("best").alias("best"))
    return out.select("g", F.col("best.route").alias("route"), (F.col("best.length") / UNITS_PER_KM).alias("km"))


def genetic_routes(stops: DataFrame, by, id_col: str = "hotspot_id", lat: str = "lat", lon: str = "lon",
                   fixed_start: bool = False, start_col: str | None = None, **rules) -> DataFrame:
    """G2 / G3 by evolution, for any number of stops -> (by, route, km).

    A row is an island: a population of routes of one group.  One generation is one expression over its
    arrays (elitism, tournaments of two, ordered crossover, swap or reversal of a random span); islands of a
    group exchange their best routes between epochs.  Every island starts with the nearest-neighbour route
    from another stop, so the result is never longer than that.  All draws are hashes of (island, generation,
    child): the same input gives the same routes.  ``rules``: ``islands``, ``population``, ``generations``,
    ``epochs``, ``mutation``, ``seed``.
    """
    by = _as_list(by)
    out = _evolved(cut_lineage(_numbered(stops, by, id_col, lat, lon, start_col)), fixed_start, **rules)
    return out.select(*[F.col("g")[c].alias(c) for c in by], "route", "km")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _evolved(s: DataFrame, fixed_start: bool, islands: int | None = None, population: int | None = None, generations: int | None = None,
             epochs: int | None = None, mutation: float | None = None, seed: int = 42) -> DataFrame:
    islands, population, generations = islands or ISLANDS, population or POPULATION, generations or GENERATIONS
    epochs, mutation = epochs or EPOCHS, MUTATION if mutation is None else mutation
    head = 1 if fixed_start else 0  # genes in front that never move
    a = s.select("g", F.col("i").alias("a"), F.col("la").alias("la1"), F.col("lo").alias("lo1"))
    b = s.select(F.col("g").alias("g2"), F.col("i").alias("b"), "la", "lo")
    leg = F.round(geo_km("la1", "lo1", "la", "lo") * UNITS_PER_KM).cast("long")
    legs = (a.join(b, F.col("g") == F.col("g2")).groupBy("g").agg(F.sort_array(F.collect_list(F.struct("a", "b", leg.alias("leg")))).alias("legs"))
            .select(F.col("g").alias("gl"), F.transform("legs", lambda x: x["leg"]).alias("legs")))  # stops^2 numbers a group
    ids = s.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", "id"))).alias("ids"))
    rows = (ids.join(legs, F.col("g") == F.col("gl")).select("g", F.transform("ids", lambda x: x["id"]).alias("ids"), "legs")
            .withColumn("n", F.size("ids")).withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))))

    def draw(below: Column, *what) -> Column:
        """A number from 0 to below - 1."""
        return F.pmod(F.xxhash64(F.lit(seed), "island", "epoch", *what), F.greatest(below, F.lit(1))).cast("int")

    def distance(x: Column, y: Column) -> Column:
        return F.col("legs")[x * F.col("n") + y]

    def measured(route: Column) -> Column:
        """struct(length, route): populations are compared by it."""
        return _let(route, lambda r: F.struct(
            F.when(F.size(r) < 2, F.lit(0).cast("long")).otherwise(F.aggregate(
                F.sequence(F.lit(0), F.size(r) - 2), F.lit(0).cast("long"), lambda t, i: t + distance(r[i], r[i + 1]))).alias("length"),
            r.alias("route")))

    every = F.sequence(F.lit(0), F.col("n") - 1)

    def nearest(start: Column) -> Column:
        """Nearest-neighbour route from a stop, ties to the smaller number."""
        def add(r, _):
            left = F.filter(every, lambda x: ~F.array_contains(r, x))
            step = F.array_min(F.transform(left, lambda x: F.struct(distance(F.element_at(r, -1), x).alias("d"), x.alias("x"))))
            return F.when(F.size(r) < F.col("n"), F.concat(r, F.array(step["x"]))).otherwise(r)
        return F.aggregate(every, F.array(start), add)

    def shuffled(who: Column) -> Column:
        keyed = F.transform(every, lambda x: F.struct(F.when(x < head, F.lit(-(2 ** 63)).cast("long")).otherwise(F.xxhash64(F.lit(seed), "island", who, x)).alias("h"), x.alias("x")))
        return F.transform(F.array_sort(keyed), lambda x: x["x"])

    first = F.lit(0) if fixed_start else F.pmod(F.col("island"), F.col("n"))
    rows = rows.withColumn("epoch", F.lit(0)).withColumn("pop", F.concat(
        F.array(measured(nearest(first))), F.transform(F.sequence(F.lit(1), F.lit(population - 1)), lambda i: measured(shuffled(i)))))

    def child(pop: Column, gen: Column, i: Column) -> Column:
        def parent(k: int) -> Column:
            x, y = (pop[draw(F.lit(population), gen, i, F.lit(2 * k + j))] for j in (0, 1))
            return F.least(x, y)["route"]

        def crossed(cut: Column) -> Column:
            lo, hi = F.least(cut["x"], cut["y"]), F.greatest(cut["x"], cut["y"]) + 1

            def mixed(kept: Column) -> Column:
                rest = F.filter(parent(1), lambda x: ~F.array_contains(kept, x))
                return _let(rest, lambda r: F.concat(F.slice(r, F.lit(1), lo), kept, F.slice(r, lo + 1, F.col("n"))))
            return _let(F.slice(parent(0), lo + 1, hi - lo), mixed)

        def mutated(route: Column) -> Column:
            def change(cut: Column) -> Column:
                lo, hi = F.least(cut["x"], cut["y"]), F.greatest(cut["x"], cut["y"])
                swap = F.transform(route, lambda x, k: F.when(k == lo, route[hi]).when(k == hi, route[lo]).otherwise(x))
                turn = F.concat(F.slice(route, F.lit(1), lo), F.reverse(F.slice(route, lo + 1, hi - lo + 1)), F.slice(route, hi + 2, F.col("n")))
                return F.when(draw(F.lit(3), gen, i, F.lit(20)) == 0, swap).otherwise(turn)
            return F.when(draw(F.lit(1000), gen, i, F.lit(21)) < int(mutation * 1000), _let(span(10), change)).otherwise(route)

        def span(k: int) -> Column:
            free = F.col("n") - head
            return F.struct((head + draw(free, gen, i, F.lit(k))).alias("x"), (head + draw(free, gen, i, F.lit(k + 1))).alias("y"))

        return measured(_let(_let(span(8), crossed), mutated))

    def generation(pop: Column, gen: Column) -> Column:
        return F.concat(F.array(F.array_min(pop)), F.transform(F.sequence(F.lit(1), F.lit(population - 1)), lambda i: child(pop, gen, i)))

    for e in range(epochs):
        # one task per island; the chosen number of partitions is kept
        rows = spread_groups(rows.withColumn("epoch", F.lit(e)), ["g", "island"])
        rows = cut_lineage(rows.withColumn("pop", F.aggregate(F.sequence(F.lit(1), F.lit(generations)), F.col("pop"), generation)))
        best = rows.groupBy(F.col("g").alias("gb")).agg(F.min(F.array_min("pop")).alias("best"))
        if e + 1 < epochs:  # the group's best route replaces the last child of every island
            rows = (rows.join(best, F.col("g") == F.col("gb")).withColumn("pop", F.concat(F.slice("pop", 1, population - 1), F.array("best")))
                    .drop("gb", "best"))
    ids = rows.where("island = 0").select("g", "ids")
    return (ids.join(best, F.col("g") == F.col("gb"))
            .select("g", F.transform("best.route", lambda i: F.col("ids")[i]).alias("route"), (F.col("best.length") / UNITS_PER_KM).alias("km")))


def route_stops(routes: DataFrame, stops: DataFrame, by, id_col: str = "hotspot_id") -> DataFrame:
    """Route array -> ordered stop rows (by, seq, id, stop columns)."""
    by = _as_list(by)
    r = routes.select(*by, F.posexplode("route").alias("seq", id_col))
    return r.join(stops, by + [id_col]).withColumn("seq", F.col("seq") + 1)
