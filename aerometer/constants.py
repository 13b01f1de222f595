"""Names, thresholds and labels that results must carry unchanged."""

# --- fixed values: focus country and region members -----------------------------------------
FOCUS_COUNTRY = "Egypt"
REGION_COUNTRIES = [
    "Egypt", "Saudi Arabia", "United Arab Emirates", "Jordan", "Kuwait", "Bahrain", "Qatar",
    "Oman", "Yemen", "Iraq", "Syria", "Lebanon", "Libya", "Tunisia", "Algeria", "Morocco",
    "Sudan", "Palestine",
]

# --- fixed values: thresholds ---------------------------------------------------------------
SPEED_CAP_KMH = 1200.0
STALE_SECONDS = 60
FEET_PER_METRE = 3.28084
KMH_PER_MS = 3.6
KNOTS_PER_MS = 1.944
HIGH_ALTITUDE_FT = 30000
FAST_KMH = 700

# --- fixed values: band edges and labels ----------------------------------------------------
ALTITUDE_EDGES = [10000, 30000]
ALTITUDE_LABELS = ["Low (< 10K ft)", "Medium (10K-30K ft)", "High (> 30K ft)"]
SPEED_EDGES = [200, 700]
SPEED_LABELS = ["Slow (< 200 km/h)", "Normal (200-700 km/h)", "Fast (> 700 km/h)"]
CLIMB_LIMIT = 1
CLIMB_LABELS = ["Climbing", "Descending", "Level"]
THERMAL_EDGES = [0, 5, 10, 15, 20, 25]
THERMAL_LABELS = ["< 0°C", "0-5°C", "5-10°C", "10-15°C", "15-20°C", "20-25°C", "> 25°C"]

# --- fixed values: dashboard step thresholds (colour from the given value upwards) ----------
SPEED_STEPS = ([600, 850], ["green", "orange", "red"])
ALTITUDE_STEPS = ([3000, 10000], ["blue", "green", "orange"])
COUNTRY_STEPS = ([300, 700], ["semi-dark-green", "semi-dark-yellow", "semi-dark-red"])
REGION_COUNT_STEPS = ([3, 10, 25, 50], ["#1F6027", "#3D9140", "#F2B705", "#E05C38", "#C4162A"])
REGION_AIR_STEPS = ([2, 8, 20], ["#1A4B6E", "#2E86C1", "#1ABC9C", "#27AE60"])
REGION_ALT_STEPS = ([3000, 8000, 11000], ["#614B79", "#8E44AD", "#B877D9", "#D7B4F3"])

# --- fixed values: dashboard relabelling ----------------------------------------------------
CLIMB_RELABEL = {"Climbing": "⬆️ Climbing", "Descending": "⬇️ Descending", "Level": "➡️ Level"}
ALTITUDE_RELABEL = {
    "Low (< 10K ft)": "🟠 Low < 10K ft",
    "Medium (10K-30K ft)": "🔵 Mid 10-30K ft",
    "High (> 30K ft)": "🟣 High > 30K ft",
}
AIR_RELABEL = {"in_air": "✈️ In Air", "on_ground": "🛬 On Ground"}

# --- fixed values: measurement names --------------------------------------------------------
M_DETAIL = "flight_details"
M_SUMMARY = "pipeline_summary"
M_CLIMB = "vertical_rate_stats"
M_BANDS = "altitude_bands"
M_REGION = "arab_world_summary"
M_REGION_COUNTRY = "arab_country_metrics"
M_COUNTRY = "country_metrics"
M_FOCUS = "egypt_summary"
M_FOCUS_DETAIL = "egypt_flight_detail"

# --- fixed values: numeric fields of a detail point, by source column -----------------------
DETAIL_FIELDS = {
    "altitude_m": "altitude_meters",
    "altitude_ft": "altitude_feet",
    "velocity_kmh": "velocity_kmh",
    "true_track": "true_track",
    "vertical_rate": "vertical_rate",
    "longitude": "longitude",
    "latitude": "latitude",
    "geo_altitude_m": "geo_altitude_meters",
}
