"""Declared schemas of the catalog tables; nothing is ever inferred."""

from pyspark.sql import types as T

STR, LONG, INT, BOOL, TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType(),
)


def _struct(**fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# One changed property of an entity: the value before and after.
PROPERTY_CHANGE = _struct(old=STR, new=STR)

INVENTORY = _struct(
    filepath=STR, size=LONG, ctime=TS, mtime=TS, dev=LONG, ino=LONG, nlink=LONG,
    is_file=BOOL, is_dir=BOOL, is_symlink=BOOL, observed_at=TS,
)

FILES = _struct(
    filepath=STR, symlink_dir=STR, name=STR, directory=STR, symlink=STR, extension=STR,
    basename=STR, batch=STR, sample=STR, size=LONG, created=TS, modified=TS, dev=LONG,
    ino=LONG, nlink=LONG, status=STR, changes=T.MapType(STR, PROPERTY_CHANGE),
    previous_version=STR, fingerprint=STR,
)

BATCHES = _struct(
    name=STR, final_summary=STR, sequencing_summary=STR, created=TS, modified=TS,
    fingerprint=STR, files=T.MapType(STR, STR), samples=T.ArrayType(STR), size=LONG,
    status=STR, changes=T.MapType(STR, T.MapType(STR, PROPERTY_CHANGE)), previous_version=STR,
)

SAMPLES = _struct(
    name=STR, sample_id=STR, files=T.MapType(STR, STR), batches=T.ArrayType(STR), size=LONG,
    created=TS, modified=TS, fingerprint=STR, tasks=T.MapType(STR, T.MapType(STR, STR)),
    processing_dir=STR, result_dir=STR, status=STR,
    changes=T.MapType(STR, T.MapType(STR, T.MapType(STR, PROPERTY_CHANGE))),
    previous_version=STR,
)

RESULTS = _struct(
    name=STR, fingerprint=STR, sample_id=STR,
    results=T.MapType(STR, T.MapType(STR, T.MapType(STR, T.ArrayType(STR)))),
    created=TS, modified=TS,
)

TASK_DATA = _struct(
    input_data=T.MapType(STR, T.ArrayType(STR)), input_files_size=LONG,
    expected_output_data=T.MapType(STR, T.MapType(STR, STR)),
    output_data=T.MapType(STR, T.MapType(STR, T.ArrayType(STR))), output_files_size=LONG,
    start_script=STR, work_dir=STR, result_dir=STR, log_dir=STR,
    head_job_stdout=STR, head_job_stderr=STR, head_job_exitcode_f=STR,
)

JOBS = _struct(
    job_id=LONG, name=STR, array_job_id=LONG, parent_job_id=LONG, nodes=T.ArrayType(STR),
    partition=STR, priority=LONG, status=STR, stderr=STR, stdout=STR, exit_code=INT,
    work_dir=STR, start=TS, limit=TS,
)

TASKS = _struct(
    task_id=STR, sample_id=STR, pipeline_id=STR, status=STR, sorting=STR, data=TASK_DATA,
    created=TS, queued=TS, finish=TS, last_update=TS, time_from_creation_to_finish=STR,
    time_in_processing=STR, slurm_main_job=JOBS, slurm_child_jobs=T.MapType(STR, JOBS),  # by job id; document keys are text
    exit_code=INT,
)

# The cluster's job listing as it arrives, before normalisation.
_NUMBER = _struct(number=LONG)
RAW_JOB = _struct(
    job_id=LONG, name=STR, array_job_id=_NUMBER, comment=STR, nodes=STR, partition=STR,
    priority=_NUMBER, job_state=T.ArrayType(STR), standard_error=STR, standard_output=STR,
    exit_code=_NUMBER, current_working_directory=STR, start_time=_NUMBER, end_time=_NUMBER,
)
JOB_SNAPSHOT = _struct(jobs=T.ArrayType(RAW_JOB))

CONDITION = _struct(field=STR, type=STR, value=STR)
INPUT_SOURCE = _struct(
    group=STR, source=STR, attributes=STR, file_mask=T.ArrayType(STR),
    requirements=T.ArrayType(STR), condition=STR,
)
EXPECTED_OUTPUT = _struct(group=STR, type=STR, mask=STR)
PIPELINES = _struct(
    pipeline_id=STR, name=STR, version=STR, sorting=STR, timeout=STR,
    conditions=T.ArrayType(CONDITION), input_data=T.ArrayType(INPUT_SOURCE),
    expected_output=T.ArrayType(EXPECTED_OUTPUT), environment=T.MapType(STR, STR),
    command_template=STR,
)

FILE_EVENTS = _struct(
    event_type=STR, src_path=STR, dest_path=STR, ts=TS, size=LONG, ctime=TS, mtime=TS,
    dev=LONG, ino=LONG, nlink=LONG, is_dir=BOOL,
)

# The status vocabularies.
INACTIVE = ("deprecated", "deleted")
TASK_STATES = ("created", "prepared", "disprepared", "queued", "processing", "completed", "failed")
JOB_END_STATES = ("COMPLETED", "TIMEOUT", "FAILED", "UNKNOWN")

# Values a stored document is read with when a field is absent.
FILE_DEFAULTS = {
    "filepath": "", "symlink_dir": "", "name": "", "directory": "", "symlink": "",
    "extension": "", "basename": "", "batch": "", "sample": "", "size": 0, "dev": 0, "ino": 0,
    "nlink": 0, "status": "indexed", "changes": {}, "previous_version": "", "fingerprint": "",
}
BATCH_DEFAULTS = {
    "name": "", "final_summary": "", "sequencing_summary": "", "fingerprint": "", "files": {},
    "samples": [], "size": 0, "status": "indexed", "changes": {}, "previous_version": "",
}
SAMPLE_DEFAULTS = {
    "name": "", "sample_id": "", "files": {}, "batches": [], "size": 0, "fingerprint": "",
    "tasks": {}, "processing_dir": "", "result_dir": "", "status": "indexed", "changes": {},
    "previous_version": "",
}
TASK_DATA_DEFAULTS = {
    "input_data": {}, "input_files_size": 0, "expected_output_data": {}, "output_data": {},
    "output_files_size": 0, "start_script": "", "work_dir": "", "result_dir": "", "log_dir": "",
    "head_job_stdout": "", "head_job_stderr": "", "head_job_exitcode_f": "",
}
RESULT_DEFAULTS = {"name": "", "fingerprint": "", "sample_id": "", "results": {}}
JOB_DEFAULTS = {"job_id": 0, "parent_job_id": 0}
TASK_DEFAULTS = {
    "task_id": "", "sample_id": "", "pipeline_id": "", "status": "", "sorting": "",
    "time_from_creation_to_finish": "", "time_in_processing": "", "slurm_child_jobs": {},
}

# Schema and defaults of every stored entity.
ENTITIES = {
    "files": (FILES, FILE_DEFAULTS), "batches": (BATCHES, BATCH_DEFAULTS),
    "samples": (SAMPLES, SAMPLE_DEFAULTS), "results": (RESULTS, RESULT_DEFAULTS),
    "tasks": (TASKS, TASK_DEFAULTS), "jobs": (JOBS, JOB_DEFAULTS), "task_data": (TASK_DATA, TASK_DATA_DEFAULTS),
}
