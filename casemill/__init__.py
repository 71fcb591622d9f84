"""Case-document processing as Spark DataFrame jobs."""

from casemill.params import ParamError, Params, RunMeta
from casemill.session import build_session

__all__ = ["ParamError", "Params", "RunMeta", "build_session"]
