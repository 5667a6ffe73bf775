"""Sources and sinks: event adapters, the partitioned lake, raw JSON landing, stores."""
