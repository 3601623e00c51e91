"""Structured Streaming: live trip counts compared with historical means."""
