"""Values that must equal the original pipeline's for identical results.

FIXED VALUES — keep as written (text, natural order).  Everything else in the
package takes column names and constants as parameters and defaults to these.
"""

# --- FIXED VALUES: raw booking record (stream and CSV), 72 string columns, in order ---
RAW_BOOKING_COLUMNS = [
    "hotel_id", "hotel_name", "country", "city", "hotel_type", "star_rating", "total_rooms",
    "hotel_facilities", "hotel_description", "nearby_attractions", "latitude", "longitude", "website",
    "customer_id", "first_name", "last_name", "full_name", "email", "phone", "birth_date", "gender",
    "country_customer", "city_customer", "address", "postal_code", "language_preference",
    "loyalty_level_customer", "registration_date", "marketing_consent",
    "booking_id", "booking_date", "checkin_date", "checkout_date", "nights", "adults", "children",
    "infants", "room_type", "rooms_booked", "booking_channel", "special_requests", "is_cancelled",
    "cancellation_date", "cancellation_reason",
    "total_price", "room_price", "tax_amount", "service_fee", "paid_amount", "payment_status",
    "payment_method", "booking_source", "promotion_code", "discount_amount",
    "created_timestamp", "updated_timestamp", "created_by", "booking_status",
    "review_id", "review_rating", "review_title", "review_text", "review_date", "helpful_votes",
    "is_verified_review", "reviewer_location", "stay_date", "trip_type", "room_type_reviewed",
    "source_system", "created_at", "updated_at",
]

# --- FIXED VALUES: cleaning ---
SPECIAL_CHARS_PATTERN = r"[!@#$%^&*().,]"
NON_DIGIT_PATTERN = r"[^0-9]"
DIGITS_ONLY_PATTERN = r"^\d+$"
TEXT_CLEAN_COLUMNS = ["hotel_id", "country_customer", "country", "city", "full_name", "hotel_name",
                      "city_customer", "address", "room_type"]
PHONE_COLUMNS = ["phone"]
COORDINATE_BOUNDS = {"latitude": (-90, 90), "longitude": (-180, 180)}
COORDINATE_PLACES = 6
UPPER_COLUMNS = ["country", "country_customer", "hotel_id"]
TITLE_COLUMNS = ["full_name", "hotel_name", "city", "city_customer"]
LOWER_TRIM_COLUMNS = ["email"]
UPPER_TRIM_COLUMNS = ["room_type"]
TITLE_TRIM_COLUMNS = ["trip_type"]
DATE_COLUMNS = ["booking_date", "birth_date", "stay_date"]
KEY_COLUMNS = ["hotel_id", "booking_id"]
BOOKING_KEY = "booking_id"

# --- FIXED VALUES: country -> language dictionary (first occurrence order; the
# original literal also repeats MEXICO, NETHERLANDS, ARGENTINA and POLAND with
# the same values, which a dictionary keeps once) ---
LANGUAGE_BY_COUNTRY = {
    "TURKEY": "Turkish", "TUR": "Turkish", "GERMANY": "German", "DEU": "German",
    "FRANCE": "French", "FRA": "French", "SPAIN": "Spanish", "ESP": "Spanish",
    "ITALY": "Italian", "ITA": "Italian", "UNITED KINGDOM": "English", "GBR": "English",
    "PORTUGAL": "Portuguese", "PRT": "Portuguese", "RUSSIA": "Russian", "RUS": "Russian",
    "NETHERLANDS": "Dutch", "NLD": "Dutch", "POLAND": "Polish", "POL": "Polish",
    "USA": "English", "UNITED STATES": "English", "BRAZIL": "Portuguese", "BRA": "Portuguese",
    "ARGENTINA": "Spanish", "ARG": "Spanish", "MEXICO": "Spanish", "MEX": "Spanish",
    "CHINA": "Chinese", "CHN": "Chinese", "JAPAN": "Japanese", "JPN": "Japanese",
    "AUSTRALIA": "English", "AUS": "English", "INDIA": "Hindi/English", "IND": "Hindi/English",
    "SOUTH AFRICA": "English/Afrikaans", "NEW ZEALAND": "English", "VIETNAM": "Vietnamese",
    "NORWAY": "Norwegian", "PHILIPPINES": "Filipino/English",
    "CZECH REPUBLIC": "Czech", "NIGERIA": "English", "CROATIA": "Croatian",
    "SOUTH KOREA": "Korean", "CANADA": "English/French", "SWEDEN": "Swedish",
    "MALAYSIA": "Malay", "SLOVAKIA": "Slovak", "COLOMBIA": "Spanish",
    "FINLAND": "Finnish", "UNITED ARAB EMIRATES": "Arabic", "MOROCCO": "Arabic/Berber",
    "SINGAPORE": "English/Mandarin", "ROMANIA": "Romanian", "THAILAND": "Thai",
    "SAUDI ARABIA": "Arabic", "AUSTRIA": "German", "ISRAEL": "Hebrew",
    "CHILE": "Spanish",
    "BELGIUM": "Dutch/French", "SWITZERLAND": "German/French/Italian", "BULGARIA": "Bulgarian",
    "SERBIA": "Serbian", "HUNGARY": "Hungarian", "PERU": "Spanish", "GREECE": "Greek",
    "KENYA": "Swahili/English", "DENMARK": "Danish",
    "IRELAND": "English/Irish", "EGYPT": "Arabic", "INDONESIA": "Indonesian",
}

# --- FIXED VALUES: enrichment fallbacks and ingest metadata ---
FALLBACK_EUR_RATE = 1.08
FALLBACK_TEMPERATURE = 20.0
BATCH_SOURCE_NAME = "Kaggle_Batch"
BASE_CURRENCY = "EUR"
CURRENCY_CODES = ["TRY", "USD", "GBP", "CHF", "CAD", "JPY"]

# --- FIXED VALUES: quality check names ---
CHECK_UNIQUE_BOOKING = "Unique Booking ID"
CHECK_NOT_NULL_HOTEL = "NotNull Hotel ID"
CHECK_STAR_RANGE = "Star Rating Range (1-5)"
CHECK_DATE_LOGIC = "Date Logic (Checkout >= Checkin)"
CHECK_PHONE_DIGITS = "Phone Format (Digits Only)"
CHECK_LAT_LONG = "Lat/Long Range Check"

# --- FIXED VALUES: gold layer ---
GOLD_FACT_VIEW = "fact_booking"
GOLD_DIM_VIEW = "dim_city"
GOLD_KPI_VIEW = "kpi_revenue"
FACT_COLUMNS = ["booking_id", "hotel_id", "hotel_name", "city", "checkin_date", "checkout_date", "nights"]
DIM_CITY_COLUMNS = ["city", "country", "latitude", "longitude"]
LATEST_N = 15
