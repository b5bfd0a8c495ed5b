"""Names, codes and units used on the wire.

Everything here must equal what the phones, watches and vendor APIs send.
"""

RECORD_TYPES = ["samples", "workouts", "sleep", "activity_summaries", "deletes"]

RECORD_TYPE_LABELS = {
    "samples": "Health Samples",
    "workouts": "Workouts",
    "sleep": "Sleep Sessions",
    "activity_summaries": "Activity Summaries",
    "deletes": "Deletions",
}

# Request headers that must never reach storage.
SECRET_HEADERS = ["authorization", "x-forwarded-access-token", "cookie", "set-cookie"]

QUANTITY_PREFIX = "HKQuantityTypeIdentifier"
CATEGORY_PREFIX = "HKCategoryTypeIdentifier"
CORRELATION_PREFIX = "HKCorrelationTypeIdentifier"
WORKOUT_TYPE = "HKWorkoutTypeIdentifier"
SLEEP_TYPE = "HKCategoryTypeIdentifierSleepAnalysis"
STAND_HOUR_TYPE = "HKCategoryTypeIdentifierAppleStandHour"

# iOS sleep analysis codes.
IOS_SLEEP_STAGES = {
    0: "inBed",
    1: "asleepUnspecified",
    2: "awake",
    3: "asleepCore",
    4: "asleepDeep",
    5: "asleepREM",
}

# Health Connect sleep stage codes.
ANDROID_SLEEP_STAGES = {
    0: "unknown",
    1: "awake",
    2: "sleeping",
    3: "out_of_bed",
    4: "light",
    5: "deep",
    6: "rem",
}

# Canonical unit per iOS quantity type; every other type is a plain count.
QUANTITY_UNITS = {
    "HKQuantityTypeIdentifierStepCount": "count",
    "HKQuantityTypeIdentifierDistanceWalkingRunning": "m",
    "HKQuantityTypeIdentifierActiveEnergyBurned": "kcal",
    "HKQuantityTypeIdentifierBasalEnergyBurned": "kcal",
    "HKQuantityTypeIdentifierHeartRate": "count/min",
    "HKQuantityTypeIdentifierRestingHeartRate": "count/min",
    "HKQuantityTypeIdentifierHeartRateVariabilitySDNN": "ms",
    "HKQuantityTypeIdentifierOxygenSaturation": "%",
    "HKQuantityTypeIdentifierAppleExerciseTime": "min",
    "HKQuantityTypeIdentifierAppleStandTime": "min",
    "HKQuantityTypeIdentifierVO2Max": "ml/kg*min",
}

# iOS workout activity codes (public HKWorkoutActivityType raw values).
IOS_ACTIVITIES = {
    1: "american_football", 2: "archery", 3: "australian_football", 4: "badminton",
    5: "baseball", 6: "basketball", 7: "bowling", 8: "boxing", 9: "climbing",
    10: "cricket", 11: "cross_training", 12: "curling", 13: "cycling", 14: "dance",
    15: "dance_inspired_training", 16: "elliptical", 17: "equestrian_sports",
    18: "fencing", 19: "fishing", 20: "functional_strength_training", 21: "golf",
    22: "gymnastics", 23: "handball", 24: "hiking", 25: "hockey", 26: "hunting",
    27: "lacrosse", 28: "martial_arts", 29: "mind_and_body",
    30: "mixed_metabolic_cardio_training", 31: "paddle_sports", 32: "play",
    33: "preparation_and_recovery", 34: "racquetball", 35: "rowing", 36: "rugby",
    37: "running", 38: "sailing", 39: "skating_sports", 40: "snow_sports",
    41: "soccer", 42: "softball", 43: "squash", 44: "stair_climbing",
    45: "surfing_sports", 46: "swimming", 47: "table_tennis", 48: "tennis",
    49: "track_and_field", 50: "traditional_strength_training", 51: "volleyball",
    52: "walking", 53: "water_fitness", 54: "water_polo", 55: "water_sports",
    56: "wrestling", 57: "yoga", 58: "barre", 59: "core_training",
    60: "cross_country_skiing", 61: "downhill_skiing", 62: "flexibility", 63: "hiit",
    64: "jump_rope", 65: "kickboxing", 66: "pilates", 67: "snowboarding",
    68: "stairs", 69: "step_training", 70: "wheelchair_walk_pace",
    71: "wheelchair_run_pace", 72: "tai_chi", 73: "mixed_cardio", 74: "hand_cycling",
    75: "disc_sports", 76: "fitness_gaming", 77: "cardio_dance", 78: "social_dance",
    79: "pickleball", 80: "cooldown", 82: "swim_bike_run", 83: "transition",
    84: "underwater_diving", 3000: "other",
}

# Health Connect exercise codes (public ExerciseSessionRecord values). Jumping
# rope, cross-country and downhill skiing have no public code; senders that use
# their own codes can extend the table they pass to the lookup.
ANDROID_EXERCISES = {
    0: "other_workout", 2: "badminton", 4: "baseball", 5: "basketball", 8: "biking",
    11: "boxing", 13: "calisthenics", 16: "dancing", 25: "elliptical",
    28: "football_american", 32: "golf", 36: "high_intensity_interval_training",
    37: "hiking", 44: "martial_arts", 48: "pilates", 51: "rock_climbing",
    53: "rowing", 56: "running", 60: "skating", 62: "snowboarding", 64: "soccer",
    68: "stair_climbing", 70: "strength_training", 72: "surfing",
    73: "swimming_open_water", 74: "swimming_pool", 75: "table_tennis", 76: "tennis",
    78: "volleyball", 79: "walking", 83: "yoga",
}

# Unit per Health Connect sample record type; other types are skipped.
ANDROID_SAMPLE_UNITS = {
    "StepsRecord": "steps",
    "DistanceRecord": "meters",
    "ActiveCaloriesBurnedRecord": "kcal",
    "BasalMetabolicRateRecord": "kcal_per_day",
    "HeartRateRecord": "bpm",
    "RestingHeartRateRecord": "bpm",
    "HeartRateVariabilityRmssdRecord": "milliseconds",
    "OxygenSaturationRecord": "percent",
    "Vo2MaxRecord": "mL/kg/min",
}

# Vendor extraction category -> bronze record type.
GARMIN_CATEGORIES = {
    "stats": "daily_stats",
    "heart_rates": "heart_rates",
    "sleep": "sleep",
    "stress": "stress",
    "hrv": "hrv",
    "spo2": "spo2",
    "body_battery": "body_battery",
    "steps": "steps",
    "respiration": "respiration",
    "activities": "activities",
}

# Daily statistics: vendor key -> (metric, unit).
GARMIN_DAILY_METRICS = {
    "restingHeartRate": ("heart_rate_resting", "bpm"),
    "totalSteps": ("steps_daily", "count"),
    "activeKilocalories": ("calories_active", "kcal"),
    "totalKilocalories": ("calories_total", "kcal"),
    "vO2MaxValue": ("vo2_max", "ml/kg/min"),
    "floorsAscended": ("floors_climbed", "count"),
    "averageStressLevel": ("stress_avg", "score"),
}

# Sleep: vendor key -> (metric, divisor, unit).
GARMIN_SLEEP_METRICS = {
    "sleepTimeSeconds": ("sleep_duration", 60.0, "minutes"),
    "deepSleepSeconds": ("sleep_deep", 60.0, "minutes"),
    "lightSleepSeconds": ("sleep_light", 60.0, "minutes"),
    "remSleepSeconds": ("sleep_rem", 60.0, "minutes"),
    "awakeSleepSeconds": ("sleep_awake", 60.0, "minutes"),
    "averageSpO2Value": ("spo2_avg", 1.0, "pct"),
    "averageRespirationValue": ("respiration_avg", 1.0, "brpm"),
}

# HRV status text -> score; any other text scores -1.
GARMIN_HRV_SCORES = {"BALANCED": 2.0, "UNBALANCED": 1.0, "LOW": 0.0}

# Activities: vendor key -> (metric, unit).
GARMIN_ACTIVITY_METRICS = {
    "duration": ("workout_duration", "seconds"),
    "distance": ("workout_distance", "meters"),
    "calories": ("workout_calories", "kcal"),
    "averageHR": ("workout_avg_hr", "bpm"),
    "maxHR": ("workout_max_hr", "bpm"),
}
