"""Fixed values that results depend on.

FIXED VALUES: these lists must stay exactly as they are for results to match
the reference pipeline.  Gaps are deliberate: the abbreviation table has no
"AL", and the United States list lacks Delaware, Iowa, Michigan, North
Dakota, Ohio, Rhode Island and Vermont, so events in those states are dropped
by the country filter.  ``COMPLETE_US_STATES`` is the opt-in fix.
"""

# FIXED VALUES — census regions, each list in the reference's order.
US_REGIONS = {
    "Northeast": [
        "Connecticut", "Massachusetts", "Maine", "New Hampshire",
        "Rhode Island", "Vermont", "New Jersey", "New York", "Pennsylvania",
    ],
    "Midwest": [
        "Illinois", "Indiana", "Iowa", "Kansas", "Michigan", "Minnesota",
        "Missouri", "Nebraska", "North Dakota", "Ohio", "South Dakota", "Wisconsin",
    ],
    "South": [
        "Alabama", "Arkansas", "Delaware", "Florida", "Georgia", "Kentucky",
        "Louisiana", "Maryland", "Mississippi", "North Carolina", "Oklahoma",
        "South Carolina", "Tennessee", "Texas", "Virginia", "West Virginia",
    ],
    "West": [
        "Alaska", "Arizona", "California", "Colorado", "Hawaii", "Idaho",
        "Montana", "Nevada", "New Mexico", "Oregon", "Utah", "Washington", "Wyoming",
    ],
}

# FIXED VALUES — state abbreviations (49 entries, "AL" absent).
STATE_ABBREVIATIONS = {
    "CA": "California", "NV": "Nevada", "OR": "Oregon", "AK": "Alaska",
    "AZ": "Arizona", "AR": "Arkansas", "CO": "Colorado", "CT": "Connecticut",
    "DE": "Delaware", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii",
    "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine",
    "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
    "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming",
}

# FIXED VALUES — states recognised as United States (43 entries).
US_STATES = [
    "California", "Alaska", "Hawaii", "Texas", "Washington", "Montana",
    "New Mexico", "Utah", "Idaho", "Oregon", "Wyoming", "Colorado",
    "New Jersey", "Tennessee", "Missouri", "Arkansas", "Arizona",
    "Kansas", "Georgia", "Maine", "South Carolina", "Nevada",
    "North Carolina", "New York", "Louisiana", "Connecticut",
    "Illinois", "Oklahoma", "Kentucky", "New Hampshire", "Virginia",
    "Nebraska", "South Dakota", "Minnesota", "Alabama", "Massachusetts",
    "Pennsylvania", "Maryland", "West Virginia", "Mississippi",
    "Wisconsin", "Florida", "Indiana",
]

# FIXED VALUES — territories (United States, but no region).
US_TERRITORIES = ["Puerto Rico", "Guam", "Northern Mariana Islands", "American Samoa"]

# FIXED VALUES — labels.
UNITED_STATES = "United States"
NORTH_AMERICA = "North America"
UNKNOWN = "Unknown"
NON_US = "Non-US"

# Opt-in completion: the seven states missing from US_STATES and the "AL"
# abbreviation missing from STATE_ABBREVIATIONS.
MISSING_US_STATES = ["Delaware", "Iowa", "Michigan", "North Dakota", "Ohio",
                     "Rhode Island", "Vermont"]
COMPLETE_US_STATES = US_STATES + MISSING_US_STATES
COMPLETE_ABBREVIATIONS = {**STATE_ABBREVIATIONS, "AL": "Alabama"}
