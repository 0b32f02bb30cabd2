from .io import (append_results, load_model, normalise_names, read_csv, read_glued, read_results, repair_records,
                 save_model, summarise_run, write_results, write_submission)

__all__ = ["append_results", "load_model", "normalise_names", "read_csv", "read_glued", "read_results", "repair_records",
           "save_model", "summarise_run", "write_results", "write_submission"]
