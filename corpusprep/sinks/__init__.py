"""corpusprep.sinks"""
