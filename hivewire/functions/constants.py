"""Fixed values.

These must equal the behaviour being reproduced for results to match: type
names, status words, command names, numeric limits and reply wording (typos
included).  They are stated once, here, in natural order.
"""

# Device types known to the default registry.
THERMOSTAT = "thermostat"
BATTERY = "battery"

# Battery status words.
CHARGING = "charging"
DISCHARGING = "discharging"
OFF = "off"
BATTERY_STATUSES = (CHARGING, DISCHARGING, OFF)

# Command names.
SET = "set"
CHANGE_STATUS = "change-status"

# Thermostat command range (inclusive) and battery hysteresis thresholds.
THERMOSTAT_MIN = -10.0
THERMOSTAT_MAX = 40.0
BATTERY_LOW = 20.0
BATTERY_HIGH = 80.0

# Initial device states.
THERMOSTAT_INITIAL_VALUE = 25.0
THERMOSTAT_UNIT = "Celsius"
BATTERY_INITIAL_PERCENTAGE = 100.0
BATTERY_INITIAL_STATUS = DISCHARGING

# Registration replies.
REGISTERED = "REGISTERED"
ALREADY_RUNNING = "DEVICE ALREADY RUNNING"
COULD_NOT_CREATE = "COULD NOT CREATE DEVICE: "
INVALID_DEVICE_NAME = "INVALID DEVICE NAME"

# Query replies.
NO_DATA_YET = "NO DATA YET"
NO_DEVICES_FOUND = "No devices found for group "

# Command replies: "Device {id} does not exist", "Group {id} does not exist",
# "Command published sucessfully for {id}",
# "Failed to publish command {cmd} for {id}. Reason: Function not Supported".
DEVICE_PREFIX = "Device "
GROUP_PREFIX = "Group "
DOES_NOT_EXIST = " does not exist"
PUBLISHED = "Command published sucessfully for "
FAILED_TO_PUBLISH = "Failed to publish command "
NOT_SUPPORTED = ". Reason: Function not Supported"
THERMOSTAT_RANGE_ERROR = "Cannot set thermostat value out of normal range!"

# Region replies: "Building {id} registered successfully",
# "Building {id} is already registered".
BUILDING_PREFIX = "Building "
BUILDING_REGISTERED = " registered successfully"
BUILDING_ALREADY = " is already registered"

# Topic names: readings /{building}/{module}/{publishingTopic}/{deviceId};
# commands {path}/cmd; registration /{building}/register and replies
# /{building}/register/{deviceId}; Kafka {prefix}-{building}.
CMD_SUFFIX = "/cmd"
REGISTER_SUFFIX = "/register"
QUERY_PREFIX = "Query"
COMMAND_PREFIX = "Command"
DATA_PREFIX = "Data"
QUERY_RESULTS_PREFIX = "Query-results"

# Gather idle timeouts (seconds): building level, group level.
BUILDING_GATHER_TIMEOUT_S = 10
GROUP_GATHER_TIMEOUT_S = 5
