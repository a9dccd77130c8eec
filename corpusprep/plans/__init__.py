"""corpusprep.plans"""
