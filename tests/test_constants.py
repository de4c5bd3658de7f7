"""The fixed values the results depend on stay as stated."""

from lodgeflow import constants as K


def test_raw_booking_record_has_72_distinct_columns():
    assert len(K.RAW_BOOKING_COLUMNS) == 72 == len(set(K.RAW_BOOKING_COLUMNS))
    assert K.RAW_BOOKING_COLUMNS[:2] == ["hotel_id", "hotel_name"]
    assert K.RAW_BOOKING_COLUMNS[-3:] == ["source_system", "created_at", "updated_at"]


def test_language_dictionary():
    assert len(K.LANGUAGE_BY_COUNTRY) == 72
    assert all(k == k.upper() for k in K.LANGUAGE_BY_COUNTRY)
    assert K.LANGUAGE_BY_COUNTRY["USA"] == "English"
    assert K.LANGUAGE_BY_COUNTRY["SWITZERLAND"] == "German/French/Italian"


def test_cleaning_and_fallback_values():
    assert K.SPECIAL_CHARS_PATTERN == r"[!@#$%^&*().,]"
    assert K.FALLBACK_EUR_RATE == 1.08 and K.FALLBACK_TEMPERATURE == 20.0
    assert K.CURRENCY_CODES == ["TRY", "USD", "GBP", "CHF", "CAD", "JPY"]
    assert K.LATEST_N == 15
    assert [K.CHECK_UNIQUE_BOOKING, K.CHECK_NOT_NULL_HOTEL, K.CHECK_STAR_RANGE, K.CHECK_LAT_LONG] == [
        "Unique Booking ID", "NotNull Hotel ID", "Star Rating Range (1-5)", "Lat/Long Range Check"]
