"""Named values shared by the library.

The block marked FIXED VALUES must keep the values the reference notebooks use;
everything else is a default of this build and may be overridden per call.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's for equal results)
# ---------------------------------------------------------------------------
PHASE_CHANNELS = ("IA", "IB", "IC")          # current phases kept by the pivot
PHASE_LETTERS = ("A", "B", "C")              # phase field written per channel
CURRENT_COMPONENT = "I"                      # circuit component monitored
AMPS = "A"                                   # unit written per channel
WRITER_SKEW = 0
WRITER_MIN = -500
WRITER_MAX = 500
WRITER_PRIMARY = 1
WRITER_SECONDARY = 1
TRIGGER_OFFSET_MS = 20                       # trigger = start + 20 ms
DEVICE_ID_MODULUS = 10000                    # device id drawn from 0..9999
FAULT_PATH_PATTERN = "external"              # path substring that marks a fault
WAVEFORM_LENGTH = 726                        # samples per training waveform
SPLIT_SEED = 42
TRAIN_FRACTION = 0.7                         # train = int(n * 0.7)
VAL_SHARE_OF_REST = 0.5                      # val = int((n - train) * 0.5)
SELECTION_EPOCHS = 64
REFIT_EPOCHS = 10
PAIR_TOLERANCE = "5 minutes"                 # |cfg time - dat time| <= 5 min
METADATA_WATERMARK = "10 seconds"
PIVOT_WATERMARK = "1 second"
GOLD_WATERMARK = "1 second"
CFG_GLOB = "*.cfg"
DAT_GLOB = "*.dat"
# ---------------------------------------------------------------------------

# Column names of the decoded-recording contract.
FILENAME = "filename"
CONFIG_CONTENT = "config_content"
DAT_CONTENT = "dat_content"
ANALOG = "analog"
ANALOG_UNITS = "analog_units"
STATUS = "status"
ANALOG_CHANNEL_NAMES = "analog_channel_names"
STATUS_CHANNEL_NAMES = "status_channel_names"
FREQUENCY = "frequency"
REC_DEV_ID = "rec_dev_id"
STATION_NAME = "station_name"
MICROSECONDS = "microseconds"
TIMESTAMP = "timestamp"
PROCESSED_TIMESTAMP = "processed_timestamp"
METADATA_COLUMNS = (FREQUENCY, STATION_NAME, REC_DEV_ID)

# Build defaults (not from the reference).
INT16_LARGEST, INT16_MISSING = 32767, -32768                  # 0x8000 marks a missing sample
INT32_LARGEST, INT32_MISSING = 2147483647, -2147483648        # 0x80000000
UINT32_LARGEST = 4294967294                                   # of a time field; all ones means none

# Mapping of the driver's ``events`` table onto long samples.
EVENT_CHANNELS = (("click", "IA"), ("view", "IB"), ("error", "IC"))
STATUS_EVENTS = ("purchase", "signup")
TEST_FRAME_LENGTH = 16
