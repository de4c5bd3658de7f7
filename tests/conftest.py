import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lodgeflow.session import get_session
    s = get_session("local[4]", app_name="lodgeflow-tests", shuffle_partitions=4,
                    extra={"spark.default.parallelism": "4",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lodgeflow-test-wh-")})
    # tests own their checkpoint folder (the cluster setting is unset here)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodgeflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="lodgeflow-test-")


def booking_row(**kw):
    """A raw booking (all text) with sensible defaults."""
    base = {c: None for c in BOOKING_COLS}
    base.update({"booking_id": "B1", "hotel_id": "h1", "hotel_name": "grand hotel", "country": "turkey",
                 "city": "istanbul", "full_name": "ada lovelace", "email": " Ada@X.COM ",
                 "phone": "+90 (212) 555-01", "country_customer": "turkey", "city_customer": "ankara",
                 "address": "street 1", "room_type": " deluxe ", "trip_type": " leisure ",
                 "latitude": "41.0", "longitude": "29.0", "booking_date": "2024-01-02",
                 "birth_date": "1990-05-06", "stay_date": "2024-01-03", "checkin_date": "2024-01-03",
                 "checkout_date": "2024-01-05", "total_price": "100", "adults": "2", "star_rating": "4",
                 "nights": "2"})
    base.update(kw)
    return base


BOOKING_COLS = ["booking_id", "hotel_id", "hotel_name", "country", "city", "full_name", "email", "phone",
                "country_customer", "city_customer", "address", "room_type", "trip_type", "latitude",
                "longitude", "booking_date", "birth_date", "stay_date", "checkin_date", "checkout_date",
                "total_price", "adults", "star_rating", "nights", "language_preference"]


@pytest.fixture
def bookings(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r[c] for c in BOOKING_COLS) for r in rows],
                                     ", ".join(f"{c} string" for c in BOOKING_COLS))
    return make
