"""Regular expressions for log lines.

Fixed values: these patterns define which text counts as a timestamp, a level,
an application and so on. They must stay as written for results to agree with
the published outputs and the documented line formats.
"""

# --- fixed values: line header -------------------------------------------
TS_HEAD = r"^(\d{2}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2})"
TS_ANY = r"(\d{2}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2})"
TS_FORMAT = "yy/MM/dd HH:mm:ss"
LEVEL_WORD = r"\b(INFO|WARN|ERROR|DEBUG)\b"
LEVEL_LOOSE = r"(INFO|WARN|ERROR|DEBUG)"
COMPONENT = r"(INFO|WARN|ERROR|DEBUG)\s+([^:]+):"

# --- fixed values: identities in text and paths ---------------------------
CLUSTER_IN_APP = r"application_(\d+)_\d+"
APPLICATION = r"(application_\d+_\d+)"
APP_IN_PATH = r"application_(\d+_\d+)"
CONTAINER = r"(container_\d+_\d+_\d+_\d+)"
CONTAINER_PARTS = r"container_(\d+)_(\d+)_(\d+)_(\d+)"
APP_NUMBER = r"_(\d+)$"
AM_CONTAINER = "000001"

# --- fixed values: message formats ----------------------------------------
EXECUTOR_REQUEST = (
    r"Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory"
    r"(?: including (\d+) MB overhead)?"
)
CONTAINER_REQUEST = r"Container request \(host: ([^,]+), capability: <memory:(\d+), vCores:(\d+)>"
TASK_LINE = (
    r"(Running|Finished) task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)"
    r"(?:\. (\d+) bytes result sent to driver)?"
)
INPUT_SPLIT = r"Input split: (\S+):(\d+)\+(\d+)"
PYTHON_TIMES = r"Times: total = (\d+), boot = (\d+), init = (\d+), finish = (\d+)"
MEMORY_STORE = r"MemoryStore started with capacity ([\d.]+) ([KMGT]?B)"
BLOCK_STORED = (
    r"Block ((broadcast|rdd)_\S+) stored as .* "
    r"\(estimated size ([\d.]+) ([KMGT]?B), free ([\d.]+) ([KMGT]?B)\)"
)
BROADCAST_READ = r"Started reading broadcast variable (\d+)"
BLOCK_ADDED = (
    r"Added (\S+) in memory on ([^:\s]+):(\d+) "
    r"\(size: ([\d.]+) ([KMGT]?B), free: ([\d.]+) ([KMGT]?B)\)"
)
BLOCK_LOCAL = r"Found block rdd_(\d+)_(\d+) locally"
RDD_BLOCK = r"(Found block|Block) rdd_(\d+)_\S+ (?:locally|stored as .* \(estimated size [\d.]+ [KMGT]?B, free [\d.]+ [KMGT]?B\))"

# --- fixed values: text that every line of a message format contains -------
MARKERS = {
    EXECUTOR_REQUEST: ("Will request ",),
    CONTAINER_REQUEST: ("Container request (",),
    TASK_LINE: ("Running task ", "Finished task "),
    INPUT_SPLIT: ("Input split: ",),
    PYTHON_TIMES: ("PythonRunner: Times: ",),
    MEMORY_STORE: ("MemoryStore started with capacity",),
    BLOCK_STORED: (" stored as ",),
    BROADCAST_READ: ("Started reading broadcast variable",),
    BLOCK_ADDED: ("Added ",),
    BLOCK_LOCAL: ("Found block rdd_",),
    RDD_BLOCK: ("Found block rdd_", "Block rdd_"),
}

# --- fixed values: size units (powers of 1024) ----------------------------
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3, "TB": 1024**4}
