"""Product-side inputs of the marts (bookings, listings, listing requests).

Partitioning: core listings, program listings and the distinct pets_allowed answers of each
listing are first joined to each other by ``listing_id`` -- small inputs, one row
per listing -- and the bookings are then joined to the result once, as the
streamed side of one LEFT join that AQE can split when a listing is hot (a chain
of joins sharing one partitioning is not split). A listing's answers travel as one array and
become rows (``exploded_pets``) after the last shuffle. Dimensions (landlords, users,
tenants) are joined while the rows are narrow and left to AQE, which turns them into broadcast
joins when their runtime size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators.aggregate import distinct_pairs
from ..sources.catalog import Sources


def _prefixed(df: DataFrame, prefix: str, cols: list[str] | None = None) -> DataFrame:
    if cols:
        df = df.select(*cols)
    return df.toDF(*[prefix + c for c in df.columns])


LISTING_COLS = ["listing_id", "city", "is_bookable", "is_online", "is_published", "is_deleted", "has_requests",
                "created_at", "available_from", "available_to", "beds", "price", "rooms", "accommodates", "area",
                "next_available_date"]


def repeated_bookings(src: Sources) -> DataFrame:
    """booking_id, listing_id and booked_from of every booking whose id occurs more than once. Ids alone are
    counted (partially before their shuffle); three narrow columns of the few rows follow. Rows whose ids are
    known to occur once (``Sources.booking_parts``) are not searched."""
    bk = src.bookings if src.booking_parts is None else src.booking_parts[1]
    ids = bk.where(F.col("booking_id").isNotNull()).groupBy("booking_id").count().where("count > 1")
    return bk.select("booking_id", "listing_id", "booked_from").join(ids, "booking_id", "left_semi")


def _partners(src: Sources, core_first: bool) -> DataFrame:
    """What the source's self-join on booking_id finds for repeated ids: one row per id and partner row, with
    the partner's core listing. The current form joins partners that have a core listing (an id without any
    has one row without values); the first version joins every partner."""
    rows = repeated_bookings(src)
    core = _prefixed(src.core_listings, "r_", LISTING_COLS)
    wanted = rows.select(F.col("listing_id").alias("w_id")).distinct()
    few = core.join(wanted, F.col("r_listing_id") == F.col("w_id")).drop("w_id")
    named = rows.select(F.col("booking_id").alias("r_booking_id"), F.col("listing_id").alias("r_lid"),
                        F.col("booked_from").alias("r_booked_from"))
    if core_first:
        return named.join(few, F.col("r_lid") == F.col("r_listing_id"), "left").drop("r_lid")
    found = named.join(few, F.col("r_lid") == F.col("r_listing_id")).drop("r_lid")
    ids = named.select("r_booking_id").distinct()
    return ids.join(found, "r_booking_id", "left")


def contacts(src: Sources, contact: str) -> DataFrame:
    """contact_id and contact: id and e-mail of every landlord or user."""
    if contact == "landlord":
        return src.landlords.select(F.col("landlord_id").alias("contact_id"), F.col("freshworks_email").alias("contact"))
    if contact == "tenant":
        return src.users.select(F.col("user_id").alias("contact_id"), F.col("email").alias("contact"))
    raise ValueError(contact)


def booked_contacts(src: Sources, contact: str, core_first: bool = False) -> DataFrame:
    """The rows of ``contacts`` that some booking refers to. The first version (``core_first``) does not find bookings
    without an id."""
    bk = src.bookings.where(F.col("booking_id").isNotNull()) if core_first else src.bookings
    ids = bk.select(F.col(f"{contact}_id").alias("b_id")).distinct()
    return contacts(src, contact).join(ids, F.col("contact_id") == F.col("b_id"), "left_semi")


def _with_partners(src: Sources, core_first: bool) -> DataFrame:
    """Bookings with ``partner``: a struct of the row that the self-join finds for a repeated id, else NULL. Rows whose
    ids are known to occur once are not joined for it."""
    found = _partners(src, core_first)
    values = [c for c in found.columns if c != "r_booking_id"]
    found = found.select("r_booking_id", F.struct(*values).alias("partner"))

    def joined(bk: DataFrame) -> DataFrame:
        j = bk.join(found, F.col("booking_id") == F.col("r_booking_id"), "left").drop("r_booking_id")
        return j.where(F.col("booking_id").isNotNull()) if core_first else j

    if src.booking_parts is None:
        return joined(src.bookings)
    once, others = src.booking_parts
    return once.withColumn("partner", F.lit(None).cast(found.schema["partner"].dataType)).unionByName(joined(others))


def _with_people(bookings: DataFrame, contact: str, people: DataFrame) -> DataFrame:
    """``bookings`` with every row of ``people`` whose contact_id is the booking's landlord or tenant."""
    return bookings.join(people, F.col(f"{contact}_id") == F.col("contact_id"), "left")


def _pets_of_listings(src: Sources, answers: bool = True) -> DataFrame:
    """lr_listing_id and lr_pets: the distinct pets_allowed answers of a listing's requests, NULL among them, or how many."""
    pairs = distinct_pairs(src.listing_requests, "listing_id", "pets_allowed")
    if not answers:
        return pairs.groupBy(F.col("listing_id").alias("lr_listing_id")).agg(F.count("*").cast("int").alias("lr_pets"))
    # a list leaves NULLs out, but not structs of NULL
    answers = pairs.groupBy("listing_id").agg(F.collect_list(F.struct("pets_allowed")).alias("answers"))
    return answers.select(F.col("listing_id").alias("lr_listing_id"), F.col("answers.pets_allowed").alias("lr_pets"))


def exploded_pets(df: DataFrame, pets: str, out: str) -> DataFrame:
    """One row per answer of the array ``pets``, as ``out``; a row without an array stays, with NULL."""
    kept = [c for c in df.columns if c != pets]
    return df.select(*kept, F.explode_outer(pets).alias(out))


def repeated_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its column ``times`` says (NULL: once), without that column."""
    kept = [c for c in df.columns if c != times]
    often = F.array_repeat(F.lit(True), F.coalesce(times, F.lit(1)))
    return df.select(*kept, F.explode(often).alias(times)).select(*kept)


def booking_model(src: Sources, contact: str = "landlord", core_first: bool = False) -> DataFrame:
    """Bookings with the values of both catalogues (core_*, rfg_*), request pairs (lr_*) and a contact.

    Equal to the source's chain of joins, with its self-join on booking_id, for repeated and NULL ids too:
    a row takes the core listing of its own listing_id if its id occurs once, else those of all rows of
    the id (``_partners``); in the current form a NULL id finds no core listing, in the first version
    (``core_first``) it finds no booking. The wide bookings are read once and joined to the
    listings once. Where staging has found ``booking_id`` to be a key, nothing of this is needed and
    the plan is the plain one. ``driver_booked_from`` is the date of the row that the first version
    drives from. ``contact_id`` is the id of the landlord or user that was found.
    """
    return exploded_pets(_packed_model(src, contact, core_first, contacts(src, contact)), "lr_pets", "lr_pets_allowed")


def _packed_model(src: Sources, contact: str, core_first: bool, people: DataFrame | None,
                  alone: DataFrame | None = None, answers: bool = True) -> DataFrame:
    """``booking_model`` with the pets answers of a row's listing as one array, ``lr_pets``, or their number (NULL: it has
    no answers) for a caller who does not read the ``answers``. ``people``: rows to join by
    contact_id, ``contacts`` or more; all their columns are kept. None: left to the caller. ``alone``: rows with columns of
    ``people`` that belong to no booking, and ``spread``, by which they are dealt; they are put to the bookings before the
    listings are joined."""
    found = [] if people is None else people.columns

    def known(rows: DataFrame) -> DataFrame:
        return rows if people is None else _with_people(rows, contact, people)

    bk, plain = src.bookings, src.booking_id_is_key
    core = _prefixed(src.core_listings, "core_", LISTING_COLS)
    rfg = _prefixed(src.listings, "rfg_", LISTING_COLS)
    pets = _pets_of_listings(src, answers)
    if not plain:
        # of several core rows of one listing, rows that do not take their own core values keep one
        order = Window.partitionBy("core_listing_id").orderBy(F.lit(1))
        core = core.where(F.col("core_listing_id").isNotNull()).withColumn("core_n", F.row_number().over(order))
    # listings of either catalogue; a request pair counts only where the program lists the listing
    both = core.join(rfg, F.col("core_listing_id") == F.col("rfg_listing_id"), "full")
    info = (both.join(pets, F.col("rfg_listing_id") == F.col("lr_listing_id"), "left")
            .withColumn("info_listing_id", F.coalesce("rfg_listing_id", "core_listing_id")))
    values = ["core_" + c for c in LISTING_COLS] + ["rfg_" + c for c in LISTING_COLS] + ["lr_pets"]
    on_listing = F.col("listing_id") == F.col("info_listing_id")
    own_date = F.col("booked_from").alias("driver_booked_from")
    if plain and src.listing_buckets:
        # bucketed alike: a chain of left joins keeps the bookings' buckets, so nothing is exchanged
        j = bk.join(core, F.col("listing_id") == F.col("core_listing_id"), "left")
        j = j.join(rfg, F.col("listing_id") == F.col("rfg_listing_id"), "left")
        j = j.join(pets, (F.col("listing_id") == F.col("lr_listing_id")) & F.col("rfg_listing_id").isNotNull(), "left")
        return known(j.select(*bk.columns, own_date, *values))
    if alone is not None:
        on_listing = F.col("has_listing") & (F.col("listing_key") == F.col("info_listing_id"))
    # one wide row per listing: looked up in a hash table, so the bookings are not sorted
    info = info.hint("shuffle_hash")

    def listed(rows: DataFrame) -> DataFrame:
        if alone is not None:
            # rows without a listing are many then: a hash of the row in place of the key deals them evenly
            rows = rows.unionByName(alone, allowMissingColumns=True)
            other = F.xxhash64("booking_id", "spread").cast("string")
            rows = rows.withColumns({"listing_key": F.coalesce("listing_id", other),
                                     "has_listing": F.col("listing_id").isNotNull()})
        return rows.join(info, on_listing, "left")

    if plain:
        return listed(known(bk)).select(*bk.columns, own_date, *values, *found)
    own = F.col("partner").isNull() & F.col("booking_id").isNotNull()
    j = listed(known(_with_partners(src, core_first)))
    j = j.where(own | F.coalesce(F.col("core_n") == 1, F.lit(True)))
    taken = [F.when(own, F.col("core_" + c)).otherwise(F.col("partner.r_" + c)).alias("core_" + c) for c in LISTING_COLS]
    driver = F.when(own, F.col("booked_from")).otherwise(F.col("partner.r_booked_from")) if core_first else F.col("booked_from")
    j = j.select(*bk.columns, driver.alias("driver_booked_from"), *taken, *values[len(LISTING_COLS):], *found)
    if core_first:
        lost = bk.where(F.col("booking_id").isNull()).select(
            F.col("listing_id").alias("l_id"), F.col("booked_from").alias("driver_booked_from"))
        lost = lost.join(core.drop("core_n"), F.col("l_id") == F.col("core_listing_id"), "left")
        j = j.unionByName(lost.drop("l_id"), allowMissingColumns=True)
    return j


def picked_bookings(src: Sources, contact: str = "landlord", core_first: bool = False,
                    people: DataFrame | None = None, alone: DataFrame | None = None, few: bool = False,
                    answers: bool = True) -> DataFrame:
    """The booking model with one value per listing attribute, all columns of ``enriched_bookings`` that do not depend
    on the reporting date, the date that the nights spent are counted from, and the pets answers of the listing as one
    array (``pets``). This is what staging writes. Columns that ``people`` has besides contact_id and contact follow;
    ``alone``: see ``_packed_model``. ``few``: the same rows for a caller of few listing values; ``people`` are joined
    after the listings, so that neither what they hold nor the rows they multiply are shuffled with the bookings.
    ``answers=False``: for a caller who reads no pets answer; ``pets`` is their number, NULL if there are none."""
    people = contacts(src, contact) if people is None else people
    more = [c for c in people.columns if c not in ("contact_id", "contact")]

    def pick(c: str):
        a, b = (F.col("core_" + c), F.col("rfg_" + c)) if core_first else (F.col("rfg_" + c), F.col("core_" + c))
        return F.coalesce(a, b)

    model = [
        F.col("booking_id"), F.col("landlord_id"), F.col("tenant_id"), F.col("actual_booking_created_at").alias("created_at"),
        F.col("booked_from"), F.col("booked_to"), F.col("is_canceled"), F.col("listing_id"),
        pick("is_online").alias("is_online"), pick("is_bookable").alias("is_bookable"),
        pick("is_published").alias("is_published"), pick("is_deleted").alias("is_deleted"),
        F.to_date(pick("available_from")).alias("listing_available_from"),
        F.to_date(pick("available_to")).alias("listing_available_to"),
        X.days_between("booked_to", "booked_from").alias("nights_per_rent_duration"),
        F.col("driver_booked_from" if core_first else "booked_from").alias("spent_from"),
        pick("price").alias("price"), pick("beds").alias("beds"), pick("city").alias("city"),
        pick("accommodates").alias("accommodates"), pick("rooms").alias("rooms"), pick("area").alias("area"),
        pick("next_available_date").alias("next_available_date"),
        pick("created_at").alias("listing_created_at"), pick("has_requests").alias("has_requests"),
        F.col("lr_pets").alias("pets"),
        F.col("number_of_tenants").alias("prd_number_of_tenants"),
    ]
    if few:
        j = _with_people(_packed_model(src, contact, core_first, None, answers=answers).select(*model), contact, people)
    else:
        j = _packed_model(src, contact, core_first, people, alone, answers).select(*model, *people.columns)
    names = j.columns[:len(model)]
    return j.select("booking_id", F.col("contact").alias("email"), "landlord_id", "tenant_id", "contact_id", *names[3:], *more)


def packed_bookings(src: Sources, as_of=None, contact: str = "landlord", core_first: bool = False,
                    people: DataFrame | None = None, alone: DataFrame | None = None, few: bool = False,
                    answers: bool = True) -> DataFrame:
    """``enriched_bookings`` with the pets answers of a row's listing still in one array, ``pets`` (or their number: ``answers``).
    Reads the staged model of the contact if there is one, else (or to join ``people``) derives it (``picked_bookings``)."""
    j = None if people is not None else src.booking_models.get((contact, core_first))
    if j is None:
        j = picked_bookings(src, contact, core_first, people, alone, few, answers)
    before, after = j.columns[:j.columns.index("spent_from")], j.columns[j.columns.index("spent_from") + 1:]
    return j.select(*before, X.nights_spent_floored("spent_from", as_of).alias("nights_spent"), *after)


def enriched_bookings(src: Sources, as_of=None, contact: str = "landlord", core_first: bool = False) -> DataFrame:
    """J5a-J5f, J5i + J8 + D15-D17: every booking with listing attributes and a contact e-mail, one row per
    distinct pets answer of its listing.

    ``core_first=False``: program value, else core value (current form, D17).
    ``core_first=True``: core value, else program value (first version, D17b).
    """
    j = packed_bookings(src, as_of, contact, core_first)
    at = j.columns.index("pets")
    return exploded_pets(j, "pets", "pets_allowed_raw").select(
        *j.columns[:at], X.to_bool("pets_allowed_raw").alias("pets_allowed"), "pets_allowed_raw", *j.columns[at + 1:])


def listings_with_landlords(src: Sources) -> DataFrame:
    """J5e / J5r + J5d: program listings with the landlord e-mail and request pets pairs."""
    ll = src.landlords.select(F.col("landlord_id").alias("ll_landlord_id"), "freshworks_email")
    ls = src.listings.join(ll, F.col("landlord_id") == F.col("ll_landlord_id"), "left")
    pairs = _prefixed(distinct_pairs(src.listing_requests, "listing_id", "pets_allowed"), "lr_")
    ls = ls.join(pairs, F.col("listing_id") == F.col("lr_listing_id"), "left")
    return ls.select(
        F.col("landlord_id"), F.col("freshworks_email"), F.lower("city").alias("prd_city"),
        F.col("listing_id"), F.col("created_at"),
        F.to_date("available_from").alias("available_from"), F.to_date("available_to").alias("available_to"),
        F.col("beds"), F.col("price"), X.price_class("price").alias("prd_rent_per_person_categorical"),
        F.col("rooms"), F.col("accommodates"), F.col("area"), F.col("city"), F.col("next_available_date"),
        F.col("has_requests"), F.col("is_bookable"), F.col("is_online"), F.col("is_published"),
        F.col("is_deleted"), F.col("lr_pets_allowed").alias("pets_allowed"),
    )


def requests_with_people(src: Sources, as_of=None, with_listing: bool = True) -> DataFrame:
    """J5f + J5g (+ J5h): listing requests with tenant e-mail, tenant row and listing."""
    us = src.users.select(F.col("user_id").alias("u_user_id"), F.col("email").alias("te_email"))
    te = src.tenants.select(F.col("tenant_id").alias("t_tenant_id"))
    lr = (src.listing_requests
          .join(us, F.col("tenant_id") == F.col("u_user_id"), "left")
          .join(te, F.col("tenant_id") == F.col("t_tenant_id"), "left"))
    if with_listing:
        ls = _prefixed(src.listings, "ls_", LISTING_COLS)
        lr = lr.join(ls, F.col("listing_id") == F.col("ls_listing_id"), "left")
    return lr


def booking_contact_keys(src: Sources, contact: str = "landlord", core_first: bool = False) -> DataFrame:
    """The contact e-mail of every booking (bookings LEFT JOIN contact dimension).

    Same key set as ``enriched_bookings`` (its other joins are LEFT joins and do
    not touch the e-mail), without the listing joins: a cheap input for the
    keys of the reconciliation. One column of the staged model if there is one. The first
    version (``core_first``) does not find bookings without an id."""
    model = src.booking_models.get((contact, core_first))
    if model is not None:
        return model.select(F.col("email").alias("k"))
    return booked_contacts(src, contact, core_first).select(F.col("contact").alias("k"))


def listing_contact_keys(src: Sources) -> DataFrame:
    """Landlord e-mail of every program listing (key source of the reconciliation)."""
    dim = src.landlords.select(F.col("landlord_id").alias("c_id"), F.col("freshworks_email").alias("k"))
    return src.listings.select("landlord_id").join(dim, F.col("landlord_id") == F.col("c_id"), "left").select("k")


def request_contact_keys(src: Sources) -> DataFrame:
    """Tenant e-mail of every listing request (key source of the reconciliation)."""
    dim = src.users.select(F.col("user_id").alias("c_id"), F.col("email").alias("k"))
    return src.listing_requests.select("tenant_id").join(dim, F.col("tenant_id") == F.col("c_id"), "left").select("k")
